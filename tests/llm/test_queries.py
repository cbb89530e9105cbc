import hashlib

from tillroll.llm import queries


def written(docs, tmp_path, rows):
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_op6_classes_documents_that_are_not_neighbours(spark, docs, tmp_path):
    near = " ".join(f"the word{i} of item{i}" for i in range(30))
    rows = [(1, near), (2, "a house by the river"), (3, near + " again"), (4, "some other of these"), (5, near)]
    found = queries.op6_spotsigs(spark, written(docs, tmp_path, rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 1}
    assert all(r.near_next < 0.8 for r in found if r.doc_id in (1, 2, 3, 4))


def test_op5_gives_the_digest_of_the_kept_text(spark, docs, tmp_path):
    line = "one two three four five six"
    rows = [(1, line), (2, f"{line}\nanother line of words that stays"), (3, None)]
    found = {r.doc_id: r for r in queries.op5_line_dedup(spark, written(docs, tmp_path, rows)).collect()}
    kept = {1: line, 2: "another line of words that stays", 3: ""}
    assert found[2].removed_lines == "0"
    assert {i: r.kept_sha256 for i, r in found.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in kept.items()}
