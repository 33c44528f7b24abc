import re

import pytest
from pyspark.sql import functions as F

from tallyshelf.llm import licenses as L
from tests.llm.samples import odd_documents, rows_of

DOC = "doc_id long, text string"


def plain_canonical(text):
    text = re.sub(L.COPYRIGHT_LINE.replace("(?imd)", ""), "", text, flags=re.I | re.M)
    form = " ".join(re.findall(r"[^\W_]+", text.lower()))
    for spelled, same in L.SPELLINGS:
        form = re.sub(rf"(?<!\S){spelled}(?!\S)", same, form)
    return form


MIT = next(t for n, t in L.KNOWN if n == "MIT" and "granted" in t)


@pytest.mark.parametrize("text", [t for _, t in L.KNOWN] + ["", "© 2020 Someone", "sub-licence licence", "(c) 2011 X\nreal words", "V3 of the Licence; V3!"])
def test_canonical_form(spark, text):
    (row,) = spark.range(1).select(L.canonical(F.lit(text)).alias("c")).collect()
    assert row.c == plain_canonical(text)


def test_variants_have_the_same_digest(spark):
    variants = [
        MIT, MIT.upper(), "Copyright (c) 2024 Some Body\n\n" + MIT, MIT.replace("\n", "  \n\n "), MIT.replace("sublicense", "sub-licence"), "/* " + MIT.replace('"', "“") + " */",
    ]
    others = [MIT + " More.", MIT[:-40], "Not a licence."]
    docs = spark.createDataFrame(list(enumerate(variants + others)), DOC)
    got = rows_of(L.scan_licenses(docs).where("unit = 'text'"))
    assert got == [(i, "text", "MIT", 1) for i in range(len(variants))]


def test_lines_and_counts(spark):
    docs = spark.createDataFrame([(1, "Some text.\nLicensed under the MIT licence!\nRELEASED under the mit license\nmore"), (2, "Released under the MIT License.")], DOC)
    assert rows_of(L.scan_licenses(docs)) == [(1, "line", "MIT", 2), (2, "line", "MIT", 1), (2, "text", "MIT", 1)]


def test_odd_rows_and_known_tables(spark):
    docs = odd_documents(spark)
    known = spark.createDataFrame([("ba", "BA."), ("ba", "Ba"), ("other", "ba"), ("none", None), ("none", "!!")], "license_id string, text string")
    assert rows_of(L.scan_licenses(docs, known)) == [(9, u, n, 1) for u in ("line", "text") for n in ("ba", "other")]
    assert L.scan_licenses(docs, known.limit(0)).count() == 0 and L.scan_licenses(docs.limit(0), known).count() == 0


def test_many_known_texts_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_TEXTS", 0)
    docs = spark.createDataFrame([(1, "Released under the MIT License.")], DOC)
    assert L.scan_licenses(docs).count() == 2


@pytest.mark.parametrize("name", L.FULL)
def test_full_texts_are_known(spark, name):
    text = dict(reversed(L.full_texts()))[name]
    docs = spark.createDataFrame([(1, text), (2, "Readme\n\n" + text.replace("\n\n", "\n * \n") + "\nThe end."), (3, text[: len(text) // 3])], DOC)
    got = rows_of(L.scan_licenses(docs).where("unit <> 'line'"))
    # The Apache licence holds its own header, so it is found twice.
    n = 2 if name == "Apache-2.0" else 1
    assert got == [(1, "lines", name, n), (1, "text", name, 1), (2, "lines", name, n)]


def test_runs_of_lines_among_other_text(spark):
    wrapped = "\n".join(" * " + " ".join(MIT.split()[i : i + 7]) for i in range(0, len(MIT.split()), 7))
    docs = spark.createDataFrame(
        [(1, "The MIT License\n\nCopyright (c) 2024 X\n\n" + MIT + "\n\nMore."), (2, f"int a;\n/*\n{wrapped}\n*/\n{wrapped}\nint b;"), (3, "x " + MIT), (3, None)], DOC
    )
    assert rows_of(L.scan_licenses(docs)) == [(1, "lines", "MIT", 1), (2, "lines", "MIT", 2)]


def test_runs_of_short_known_texts(spark):
    docs = spark.createDataFrame([(1, "a\n\nBE good\n and kind.\nb"), (2, "be\ngood"), (3, "© be\nbe\n(c) 2020 X\ngood and kind")], DOC)
    known = spark.createDataFrame([("k", "Be good\nand kind"), ("s", "be\n good"), ("n", "and kind b")], "license_id string, text string")
    got = [r for r in rows_of(L.scan_licenses(docs, known)) if r[1] == "lines"]
    assert got == [(1, "lines", "k", 1), (1, "lines", "s", 1), (2, "lines", "s", 1), (3, "lines", "k", 1), (3, "lines", "s", 1)]


def plain_runs(docs, known):
    """Every known text of several lines or many words, from every line on, by comparing whole canonical forms."""
    found = {}
    forms = {(n, plain_canonical(t)) for n, t in known if sum(1 for line in t.split("\n") if plain_canonical(line)) > 1 or len(plain_canonical(t).split()) >= L.RUN_WORDS}
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        for i, line in enumerate(lines):
            rest = plain_canonical("\n".join(lines[i:])) + " "
            for name in {n for n, form in forms if form and plain_canonical(line) and rest.startswith(form + " ")}:
                found[doc_id, "lines", name] = found.get((doc_id, "lines", name), 0) + 1
    return sorted(((*k, n) for k, n in found.items()), key=repr)


def odd_runs():
    """Lines that begin like known texts, alone and above each other, known starts cut off, spellings that lines part."""
    known = [
        ("long", "We grant\n" + " ".join(f"w{i}" for i in range(300))), ("longer", "We grant\n" + " ".join(f"w{i}" for i in range(2000)) + " end"),
        ("short", "we\ngrant"), ("merged", "a non infringement\nv2.0 and sub licence"), ("said", "non-commercial\nuse"), ("next", "commercial\nuse"),
    ]
    run = "we grant " + " ".join(f"w{i}" for i in range(2000))
    texts = [
        known[0][1], known[1][1], run, run + " end", "We grant\n" * 40 + known[1][1], "we\n\n--\n© 2020 X\ngrant\nWE GRANT w0 w1", " ".join(run.split()[:302]), " ".join(run.split()[:301]),
        "a\nnon\ninfringement version 2\n0 and sublicense", "A noninfringement v2\n0 and sub\nlicence more", "non\ncommercial\nuse", "non commercial\n\nuse", None, "", "\n\n", "-" * 5000, "we",
    ]
    return list(enumerate(texts)), known


@pytest.mark.parametrize("limit", [L.BROADCAST_TEXTS, 0])
def test_runs_as_plain_search_finds_them(spark, monkeypatch, limit):
    monkeypatch.setattr(L, "BROADCAST_TEXTS", limit)
    docs, known = odd_runs()
    got = L.scan_licenses(spark.createDataFrame([*docs, docs[4]], DOC), spark.createDataFrame(known, "license_id string, text string"))
    assert [r for r in rows_of(got) if r[1] == "lines"] == plain_runs([*docs, docs[4]], known)


def test_sql_of_full_texts_and_runs(spark):
    import duckdb

    from tallyshelf.llm.statements import LICENSES

    texts = dict(reversed(L.full_texts()))
    docs = [(1, texts["GPL-2.0"]), (2, "Readme\n" + texts["Apache-2.0"] + "\nmore"), (3, "x\n" + MIT.replace("sublicense", "sub\nlicence") + "\n" + MIT), (4, None), (5, texts["MPL-2.0"][:900])]
    want = sorted(duckdb.connect().execute(f"WITH documents AS (FROM (VALUES {', '.join('(?, ?)' for _ in docs)}) AS v(doc_id, text)) {LICENSES.strip().replace('WITH t AS', ', t AS', 1)}", [x for row in docs for x in row]).fetchall(), key=repr)
    assert want and rows_of(L.scan_licenses(spark.createDataFrame(docs, DOC))) == want


def test_lines_that_all_begin_like_a_licence(spark):
    """Few of a text's words are read for each of its lines, so such a text takes time by its length."""
    header = " ".join(dict(L.full_texts())["GPL-3.0"].split()[:12])
    docs = spark.createDataFrame([(1, "\n".join([header] * 4000)), (2, "\n".join([header] * 2000) + "\n" + MIT)], DOC)
    known = L.known_digests(L.known_table(spark)).where("in_runs").withColumnRenamed("n_words", "run_words")
    rows = docs.select("doc_id", F.col("text").alias("body"), F.lit(0).alias("row"))
    words = L._places_of_few(rows, known, [L.ANCHOR_WORDS]).select(F.aggregate(F.transform("at", lambda s: s["reach"]), F.lit(0), lambda a, b: a + b).alias("n"))
    assert all(r.n <= 80 * 4000 for r in words.collect())
    assert rows_of(L.scan_licenses(docs)) == [(2, "lines", "MIT", 1)]
