"""Queries against their DuckDB SQL, and the pipeline against its stages."""
import duckdb
import pytest

from paperlane.llm import decontaminate, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = c.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    got = queries.REGISTRY[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(want.select(", ".join(cols)).fetchall())


def test_pipeline(spark):
    """Each stage's decisions, restated on the stage's own input."""
    import corpus_pipeline as pipeline
    from paperlane.llm.common import written

    from .test_simhash import slow_components, slow_fingerprint
    from .test_text_rules import slow_dedup, slow_hits

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if name != "toxicity" else {}
        docs = written(stage(spark, docs, SF), "test-stage")
        after = {r.doc_id: r for r in docs.collect()}
        seen[name] = after
        if name != "byte_bpe":
            assert docs.columns == cols
        if name == "line_dedup":
            want = slow_dedup(sorted(before.items()))
            assert {i: (r.text, r.n_chars) for i, r in after.items()} == {i: (t, len(t)) for i, (t, _, _) in want.items()}
        if name == "simhash_dedup":
            groups = slow_components({i: slow_fingerprint(t) for i, t in before.items()})
            assert set(after) == {i for i, root in groups.items() if i == root}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {i for i, t in before.items() if not slow_hits(t, items)[1]}
        if name == "byte_bpe":
            import tiktoken
            import public_tokenizers as P
            from paperlane.llm.bpe import read_ranks

            enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")),
                                    special_tokens={})
            assert {i: list(r.ids) for i, r in after.items()} == {i: enc.encode_ordinary(t) for i, t in before.items()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    every = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    gone = every - set(seen["toxicity"])
    assert gone and sum(labels.get(i, 1) == 1 for i in gone) >= 0.9 * len(gone)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "byte_bpe"]
    assert decontaminate.WINDOW == 10 and simhash.MOST == 4096


def test_stages_decide_by_row(spark):
    from paperlane.llm import stages

    from .util import docs, prose

    x, y, z = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = docs(spark, [(1, x), (5, x), (0, y), (1, y), (None, x), (None, z), (None, z), (7, z)])
    kept = stages.keep_one_of_each_group(spark, rows, SF)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, x), (0, y), (7, z)])
    item = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=len)
    rows = docs(spark, [(None, item), (None, x), (3, item), (3, y)])
    kept = stages.drop_contaminated(spark, rows, SF)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(None, x), (3, y)}
