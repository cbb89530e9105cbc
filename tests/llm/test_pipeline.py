import corpus_pipeline
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.oracle_check import connect, compare
from tillroll.llm import queries, toxicity
from tillroll.llm.common import stored, table

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_version(spark):
    docs = table(spark, SF_DIR, "documents")
    scores = {r.doc_id: r.score for r in toxicity.judge(docs, table(spark, SF_DIR, "labels")).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] < 0.5]
    gone = plain_lines(rows)
    left = []
    for doc_id, text in rows:
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(doc_id, []))
        if kept.strip() or doc_id not in gone:
            left.append((doc_id, kept))
    left.sort()
    groups = plain_components([plain_fingerprint(t) for _, t in left])
    final = [row for i, row in enumerate(left) if groups[i] == i]

    stages, frame = dict(corpus_pipeline.STAGES), docs
    names = list(stages)
    assert names == ["toxicity", "line_dedup", "simhash_dedup", "packing"]
    for name in names[:-1]:
        frame = stored(stages[name](spark, frame, SF_DIR), name)
        assert frame.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in frame.collect()) == final
    assert all(r.n_chars == len(r.text) for r in frame.collect())
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in final}
    numbers = {doc_id: n for n, (doc_id, _) in enumerate(final)}
    renamed = [type(r)(**{**r.asDict(), "doc_id": numbers[r.doc_id]}) for r in packed]
    check(renamed, [t for _, t in final], 4096)


def test_stages_on_empty_and_odd_tables(spark, docs):
    rows = [(1, ""), (2, None), (3, "a b c d e f"), (3, "a b c d e f"), (None, "x y z"), (4, "word " * 100_000)]
    for frame, count in ((docs([]), 0), (docs(rows), 1)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stored(stage(spark, frame, SF_DIR), name)
        assert (frame.count() > 0) == bool(count)


def test_every_query_with_sql_equals_it(spark):
    con = connect(SF_DIR)
    for name, sql in queries.ORACLES.items():
        assert compare(spark, con, name, queries.QUERIES[name], sql, SF_DIR) is None
    numbers = {int(name[2:].split("_")[0]) for name in queries.QUERIES}
    assert numbers == set(range(1, 11))
