import re

from pyspark.sql import functions as F

from tallyshelf.llm.quality import Rule, base_counts, filter_documents, judge, order_rules, rules
from tests.llm.samples import odd_documents, prose


def plain_repeats(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)})


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), plain_repeats(words))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts(spark):
    words = prose(30, 1).split()
    texts = [
        " ".join(words + words[3:20] + words[5:14]), " ".join(words[:8] * 2), " ".join(["a"] * 9), " ".join(["a"] * 8), "a b\na b\n\n \n\na b\tc", "x y z\x1cq",
        "#*$%&|<> \x0b\x0c tail", "\n".join(["same line here"] * 5), "漢😀 " * 30, None, "",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in base_counts(rows).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = judge(docs).collect()
    assert len(rows) == docs.count()
    texts = {(r.doc_id, plain_counts(r.text)) for r in docs.collect()}
    assert {(r.doc_id, tuple(r[c] for c in COUNTS)) for r in rows} == texts
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.rejected_by is None) and (not r.base_failed or r.rejected_by == "base")
    kept = filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert {r.doc_id for r in rows if r.kept} >= {1, 2, 3, 4, 10}


def test_order_never_changes_the_verdict(spark):
    docs = odd_documents(spark)
    one, two = judge(docs, rules()), judge(docs, rules()[::-1])
    assert sorted(map(repr, one.select("doc_id", "kept").collect())) == sorted(map(repr, two.select("doc_id", "kept").collect()))


def test_rules_that_reject_more_per_second_go_first(spark):
    rows = spark.range(200).selectExpr("id AS doc_id", "repeat('word and ', 40) AS text", "array('a') AS words", "id AS n_words")
    never, often = Rule("never", F.col("n_words") < 0), Rule("often", F.col("n_words") > 5)
    dear = Rule("dear", (F.length(F.regexp_replace("text", "(a|b|[c-z])+?(?=x*)", "")) >= 0) & (F.col("n_words") > 190))
    assert [r.name for r in order_rules(rows, [never, dear, often])][0] == "often"


def test_empty(spark):
    docs = odd_documents(spark).limit(0)
    assert judge(docs).count() == 0 and filter_documents(docs).count() == 0
