"""Every registered query of the subpackage against its SQL, and the pipeline against a plain version."""

import zlib

import duckdb
import pytest

from checks.compare import connect, rows_of
from tallyshelf.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_thirteen_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries())
    assert numbers == list(range(1, 14))
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_agrees_with_sql(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and rows_of(got) == rows_of(want)


def documents():
    return duckdb.connect().execute(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def test_leaks_are_those_of_a_plain_search(spark):
    from tests.llm.test_decontaminate import plain_leaks

    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    got = registry.queries()["op1_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id, r.passage, r.edits) for r in got} == plain_leaks([d[:2] for d in documents()], items)


def test_language_of_held_out_documents(spark):
    got = {r.doc_id: r for r in registry.queries()["op5_language"](spark, SF).collect()}
    held = [(d, lang) for d, _, lang in documents() if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r.held_out} == {d for d, _ in held}
    assert sum(got[d].lang_pred == lang for d, lang in held) >= 0.9 * len(held)


def test_spans_are_those_of_a_plain_search(spark):
    from tests.llm.test_suffix_dedup import plain_spans

    got = sorted(tuple(r) for r in registry.queries()["op9_suffix_dedup"](spark, SF).collect())
    assert got == sorted(plain_spans([(d, t) for d, t, _ in documents()]))


def test_shards_are_those_of_the_published_loop(spark):
    from tests.llm.test_sharding import plain_jump, spark_hash

    got = registry.queries()["op4_sharding"](spark, SF).collect()
    texts = {d: (t or "").encode() for d, t, _ in documents()}
    for r in got:
        assert (r.shard, r.grown_shard) == (plain_jump(spark_hash(r.doc_id), 16), plain_jump(spark_hash(r.doc_id), 17))
        assert (r.size, r.text_crc32, r.law) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "key")
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_toxicity_of_held_out_documents(spark):
    """On the next larger tables: the smallest have nine toxic rows to learn from. A twentieth of the labels is flipped, so about a third of
    the rows that are marked toxic are not, and no classifier finds those."""
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.queries()["op11_toxicity"](spark, sf).collect()}
    assert len(got) == 1000
    labels = duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall()
    held = [(d, y) for d, y in labels if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out for d, _ in held) and sum(got[d].predicted == y for d, y in held) >= 0.9 * len(held)
    assert sum(got[d].predicted for d, y in held if y) >= 0.5 * sum(y for _, y in held)


def turns():
    return duckdb.connect().execute(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()


def test_trie_nodes_are_those_of_all_prefixes(spark):
    from tests.llm.test_prefix_trie import plain_grafts, plain_nodes, plain_turns

    got = sorted((tuple(r) for r in registry.queries()["op12_prefix_trie"](spark, SF).collect()), key=repr)
    assert got == plain_nodes(plain_grafts(plain_turns(turns())))


def test_repairs_are_those_of_a_plain_table(spark):
    from tests.llm.test_structure_repair import plain_repairs

    got = {r[0]: tuple(r)[1:] for r in registry.queries()["op13_structure_repair"](spark, SF).collect()}
    assert got == plain_repairs(turns())


def test_pipeline_is_its_stages_one_after_the_other(spark):
    """The plain version: each stage's rule applied to rows in Python, from the operators' own results."""
    import corpus_pipeline as P
    from tallyshelf.llm.language import identify
    from tests.llm.test_decontaminate import plain_leaks
    from tests.llm.test_mixing import plain_copies
    from tests.llm.test_near_duplicates import plain_components
    from tests.llm.test_sharding import plain_jump, spark_hash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    sure = {r.doc_id for r in identify(docs).collect() if r.lang_pred != "und" and r.score >= P.LEAST_SCORE}
    rows = [r for r in docs.collect() if r.doc_id in sure]
    kept = plain_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if kept[r.doc_id] == r.doc_id]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in plain_leaks([(r.doc_id, r.text) for r in rows], items)}
    rows = [r for r in rows if r.doc_id not in leaks]
    copies = plain_copies([(r.doc_id, r.source, r.text) for r in rows])
    want = sorted(tuple(r) + (plain_jump(spark_hash(r.doc_id), P.SHARDS),) for r in rows for _ in range(copies[r.doc_id]))
    got = P.run(spark, SF)
    assert got.columns == [*names, "shard"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert [name for name, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
