"""What a stream has taken on is skipped later: across batches and restarts,
until its time to live is over; targets of others are listed for each batch."""
import datetime as dt
import os
import tempfile

from paperlane.streaming import jobs as sj

T = dt.datetime(2024, 1, 1)
SCHEMA = "container string, name string, last_modified timestamp, size long"


class Poll:
    """A folder of listings, one file a batch, and the stream over it."""

    def __init__(self, spark, ttl="1 day", existing=()):
        self.spark, self.ttl, self.n = spark, ttl, 0
        self.dir = tempfile.mkdtemp(prefix="poll-")
        self.exists(*existing, "never")

    def exists(self, *names):
        self.spark.createDataFrame([(n,) for n in names], "name string").write.mode("append").parquet(f"{self.dir}/existing")

    def batch(self, *rows):
        """New listing rows (name, hours), then the query is started (again) until it has read them."""
        self.n += 1
        new = f"{self.dir}/in/{self.n:03d}"
        self.spark.createDataFrame([("c", n, T + dt.timedelta(hours=h), 1) for n, h in rows], SCHEMA).coalesce(1).write.parquet(new)
        src = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.dir}/in/*")
        todo = sj.first_of_target(src, self.ttl)
        sink = sj.skipping_sink(lambda s: s.read.parquet(f"{self.dir}/existing"), sj.route_sink(f"{self.dir}/out"))
        (todo.writeStream.foreachBatch(sink).option("checkpointLocation", f"{self.dir}/ck").trigger(availableNow=True).start()
         .awaitTermination())
        return sorted(r.name for r in self.spark.read.schema(SCHEMA).parquet(f"{self.dir}/out").collect())


def test_a_later_batch_skips_what_an_earlier_one_took_on(spark):
    p = Poll(spark)
    assert p.batch(("a_tr.pdf", 0), ("b_tr.pdf", 0)) == ["a_tr.pdf", "b_tr.pdf"]
    assert p.batch(("a_de.pdf", 1), ("c_de.pdf", 1)) == ["a_tr.pdf", "b_tr.pdf", "c_de.pdf"]  # the query was restarted
    assert p.batch(("a_fr.pdf", 2), ("a_es.pdf", 2)) == ["a_tr.pdf", "b_tr.pdf", "c_de.pdf"]


def test_targets_of_others_are_listed_for_each_batch(spark):
    p = Poll(spark, existing=["a_en.pdf"])
    assert p.batch(("a_tr.pdf", 0), ("b_tr.pdf", 0)) == ["b_tr.pdf"]
    p.exists("c_en.pdf")
    assert p.batch(("c_tr.pdf", 1), ("d_tr.pdf", 1)) == ["b_tr.pdf", "d_tr.pdf"]


def test_state_has_a_time_to_live(spark):
    p = Poll(spark, ttl="2 hours")
    p.batch(("a_tr.pdf", 0))
    p.batch(("z_tr.pdf", 1))
    assert p.batch(("a_de.pdf", 1)) == ["a_tr.pdf", "z_tr.pdf"]
    p.batch(("y_tr.pdf", 30))  # the watermark passes the state's time
    p.batch(("x_tr.pdf", 31))
    assert "a_fr.pdf" in p.batch(("a_fr.pdf", 32))


def test_one_of_several_in_a_batch_and_the_batch_form(spark):
    p = Poll(spark)
    rows = [(f"hot_{c}e.pdf", 0) for c in "abcdf"] + [("cold_de.pdf", 0)]
    assert len(p.batch(*rows)) == 2
    listing = spark.createDataFrame([("c", n, T + dt.timedelta(hours=h), 1) for n, h in [("a_tr.pdf", 1), ("a_de.pdf", 0), ("a_aa.pdf", 0), ("b.pdf", 5)]], SCHEMA)
    got = sj.first_of_target(listing)
    assert got.columns == listing.columns and sorted(r.name for r in got.collect()) == ["a_aa.pdf", "b.pdf"]


def test_a_replayed_batch_writes_the_same(spark):
    p = Poll(spark)
    p.batch(("a_tr.pdf", 0))
    sink = sj.skipping_sink(lambda s: s.read.parquet(f"{p.dir}/existing"), sj.route_sink(f"{p.dir}/out"))
    rows = spark.createDataFrame([("c", "a_tr.pdf", T, 1)], SCHEMA)
    for _ in range(2):
        sink(rows, 0)
    assert [r.name for r in spark.read.parquet(f"{p.dir}/out").collect()] == ["a_tr.pdf"]


def test_after_the_duplicate_filter(spark):
    """Two stateful steps in a row; the second takes the watermark of the first."""
    d = tempfile.mkdtemp(prefix="poll-")
    spark.createDataFrame([("c", n, T, 1) for n in ("a_tr.pdf", "a_tr.pdf", "a_de.pdf", "b.pdf")], SCHEMA).write.parquet(os.path.join(d, "in"))
    src = spark.readStream.schema(SCHEMA).parquet(os.path.join(d, "in"))
    out = sj.first_of_target(sj.new_documents(src), None)
    q = out.writeStream.format("memory").queryName("twice").option("checkpointLocation", os.path.join(d, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("twice").count() == 2
