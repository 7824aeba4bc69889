import datetime as dt
import re
import tempfile

from paperlane.operators.listing import reconcile_unprocessed
from paperlane.operators.manifest import TargetManifest
from paperlane.sources import fixtures as fx
from tests.conftest import SF_SMALL

KINDS = "container string, name string, last_modified timestamp, size long"


def names(df):
    return sorted(r.name for r in df.collect())


def test_manifest_is_read_without_an_exchange(spark):
    source, target = (f(spark, SF_SMALL, fx.AS_OF_BLOB) for f in (fx.source_blobs, fx.target_blobs))
    manifest = TargetManifest(spark, tempfile.mkdtemp(prefix="paperlane-manifest-"), buckets=4)
    manifest.add(target)
    left = manifest.reconcile(source, fx.AS_OF_BLOB)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the worklist's
    manifest_side = plan[plan.index("SortMergeJoin"):].split("Exchange hashpartitioning")
    assert "Bucketed: true" in manifest_side[-1]
    assert names(left) == names(reconcile_unprocessed(source, target, fx.AS_OF_BLOB)) != []


def test_manifest_grows_and_is_opened_again(spark):
    at = dt.datetime(2024, 1, 10, 9)
    source = spark.createDataFrame([("raw", n, at, 1) for n in ("a.pdf", "b.pdf", "c.pdf", "d.txt")], KINDS)
    path = tempfile.mkdtemp(prefix="paperlane-manifest-")
    manifest = TargetManifest(spark, path, buckets=3)
    manifest.add(source.limit(0))
    assert names(manifest.reconcile(source, at)) == ["a.pdf", "b.pdf", "c.pdf"]
    manifest.add(spark.createDataFrame([("ocr", "a_ocr.pdf", at, 1), ("ocr", "c_ocr.pdf", at - dt.timedelta(days=1), 1)], KINDS))
    assert names(manifest.reconcile(source, at)) == ["b.pdf", "c.pdf"]  # c's is of another day
    other = spark.newSession()  # the catalog is shared: the table is found by its path
    again = TargetManifest(other, path, buckets=3)
    again.add(spark.createDataFrame([("ocr", "a_ocr.pdf", at, 1), ("ocr", "B_enhanced_ocr.pdf", at, 1)], KINDS))
    assert names(manifest.reconcile(source, at)) == ["c.pdf"]
    spark.sql(f"DROP TABLE {manifest.table}")  # an external table: its files stay
    assert names(TargetManifest(spark, path, buckets=3).reconcile(source, at)) == ["c.pdf"]
