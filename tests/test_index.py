"""The articles table and the stream that feeds it."""

import json

import pytest

from clipyard.session import scratch_path
from clipyard.sinks import articles as table
from clipyard.sinks import routing
from clipyard.sources.index_messages import articles_to_index, index_messages
from clipyard.streaming.index_stream import start_indexing


def message(seq, url, text="body", **more):
    return (seq, json.dumps({"url": url, "topic": "t", "filling": text, **more}))


MESSAGES = [
    message(1, "a"),
    message(2, "b", what_to_do=0),
    message(3, "a"),
    message(4, "a", "changed"),
    message(5, "c", what_to_do=2),
    (6, "not json at all"),
]


def decoded(spark, rows):
    return index_messages(spark.createDataFrame(rows, "seq long, value string"), "seq")


def view(rows):
    return sorted((r["seq"], r["url"], r["filling"]) for r in rows.collect())


def test_messages(spark):
    rows = {r["seq"]: r for r in decoded(spark, MESSAGES).collect()}
    assert rows[1]["author"] == "" and rows[1]["what_to_do"] == 0 and rows[5]["what_to_do"] == 2
    assert set(rows) == {1, 2, 3, 4, 5}
    assert {r["seq"] for r in articles_to_index(decoded(spark, MESSAGES[:5])).collect()} == {1, 2, 3, 4}


def test_append_keeps_all_and_upsert_the_latest(spark):
    path = scratch_path(spark, "t")
    rows = articles_to_index(decoded(spark, MESSAGES[:5]))
    writer = table.append_batch(rows, path, 0)
    table.append_batch(rows, path, 0, writer)  # a retried batch replaces itself
    assert [s for s, _, _ in view(table.read_all(spark, path))] == [1, 2, 3, 4]
    want = [(2, "b", "body"), (3, "a", "body"), (4, "a", "changed")]
    assert view(table.latest(table.read_all(spark, path))) == want
    assert view(table.latest(table.read_all(spark, path), key="url")) == [want[0], want[2]]
    target = scratch_path(spark, "compacted")
    table.compact(spark, path, target)
    assert view(table.read_all(spark, target)) == want


def test_declared_table(spark):
    path = scratch_path(spark, "t")
    table.append_batch(articles_to_index(decoded(spark, MESSAGES[:2])), path, 7)
    for _ in range(2):
        table.create_if_absent(spark, "site_articles", path)
    spark.sql("ALTER TABLE site_articles RECOVER PARTITIONS")
    assert spark.table("site_articles").count() == 2
    spark.sql("DROP TABLE site_articles")


def write_file(spark, folder, rows):
    spark.createDataFrame(rows, "seq long, value string").coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_and_restarts_cleanly(spark):
    folder, path, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    for row in MESSAGES[:3]:
        write_file(spark, folder, [row])

    def run():
        source = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", 1).parquet(folder)
        start_indexing(source, path, state).awaitTermination()
        return table.read_all(spark, path)

    batch = scratch_path(spark, "batch")
    table.append_batch(articles_to_index(decoded(spark, MESSAGES[:3])), batch, 0)
    assert view(table.latest(run())) == view(table.latest(table.read_all(spark, batch)))
    assert run().count() == 3  # the same checkpoint has nothing left to do
    write_file(spark, folder, [message(9, "a"), MESSAGES[3]])  # a later crawl
    assert run().count() == 5
    assert view(table.latest(run(), key="url")) == [(2, "b", "body"), (9, "a", "body")]


def test_writers_never_replace_each_other(spark):
    folder, path = scratch_path(spark, "in"), scratch_path(spark, "t")
    table.append_batch(articles_to_index(decoded(spark, MESSAGES[:4])), path, 0)
    write_file(spark, folder, [message(20, "z")])
    source = spark.readStream.schema("seq long, value string").parquet(folder)
    for expected in (5, 6):  # the second checkpoint starts at batch 0 again
        start_indexing(source, path, scratch_path(spark, "state")).awaitTermination()
        assert table.read_all(spark, path).count() == expected
    compacted = scratch_path(spark, "compacted")
    table.compact(spark, path, compacted)
    start_indexing(source, compacted, scratch_path(spark, "state")).awaitTermination()
    assert table.read_all(spark, compacted).count() == 4 + 1
    assert table.latest(table.read_all(spark, compacted)).count() == 4


def test_equal_sequence_numbers_give_one_stable_row(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 0, "c"), (None, 2, "d"), (None, 1, "e")], "key string, seq long, v string")
    found = sorted(map(tuple, table.latest(rows, "key").collect()), key=str)
    again = sorted(map(tuple, table.latest(rows.orderBy("v").repartition(3), "key").collect()), key=str)
    assert found == again and len(found) == 2 and found[-1][1] in (1, 2)


def test_latest_shuffles_only_what_the_reader_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("u", 1, "x" * 9, "b"), ("u", 1, "y" * 9, "a"), ("v", 2, None, "c")],
                          "url string, seq long, wide string, note string").write.parquet(path)
    rows = spark.read.parquet(path)
    left = table.latest(rows, key="url").select("url", "note")
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):].splitlines()[1]
    assert "Project" in joined and "_tie" in joined and ", wide#" not in joined.split(" AS _tie")[-1]
    whole = {r.url: r.note for r in table.latest(rows, key="url").collect()}
    assert {r.url: r.note for r in left.collect()} == whole and len(whole) == 2


@pytest.mark.parametrize("mode", ["append"])
def test_routing(spark, mode):
    rows = [("a", "1"), ("b", "2"), ("c", "3"), (None, "4")]
    messages = spark.createDataFrame(rows, "route string, value string")
    delivered = routing.route(messages, {"q1": ["a", "b"], "q2": ["b"]})
    assert sorted((r["queue"], r["value"]) for r in delivered.collect()) == [("q1", "1"), ("q1", "2"), ("q2", "2")]
    path = scratch_path(spark, "queues")
    routing.write_queues(delivered, path, mode)
    assert sorted(r["value"] for r in spark.read.text(f"{path}/queue=q1").collect()) == ["1", "2"]


def test_published_messages_decode_to_what_was_sent(spark):
    rows = decoded(spark, MESSAGES[:2]).drop("what_to_do")
    sent = routing.publish_articles(rows, keep=["seq"])
    again = index_messages(sent, "seq").drop("what_to_do")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))


def test_stream_reads_a_table_stored_as_a_file_or_a_folder(spark, tmp_path):
    from clipyard.plans import registry

    docs = spark.createDataFrame([(i, f"a text of {i} words") for i in range(6)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "10L AS n_chars")
    docs.repartition(2).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    (tmp_path / "file").mkdir()
    docs.coalesce(1).write.parquet(str(tmp_path / "part"))
    next((tmp_path / "part").glob("part-*.parquet")).rename(tmp_path / "file" / "documents.parquet")
    folder, file = (registry.stream_index(spark, str(tmp_path / n)).collect() for n in ("folder", "file"))
    assert len(folder) == 6 and sorted(map(tuple, folder)) == sorted(map(tuple, file))
