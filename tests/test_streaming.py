"""Streaming conform over a file source (availableNow)."""

import os
import shutil

from trueform.streaming.incremental import conform_stream, settle
from trueform.workloads.conform_q import EVENTS_SPEC, EVENTS_DIRT, _split_select

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    # the same file twice: every key of the second batch repeats one of the first
    shutil.copy(os.path.join(SF, "events.parquet"), src / "part-0.parquet")
    whole = spark.read.parquet(str(src))
    half = whole.where("event_id % 4 = 0")
    half.coalesce(1).write.parquet(str(tmp_path / "more"))
    more = next((tmp_path / "more").glob("part-*.parquet"))
    shutil.copy(more, src / "part-1.parquet")
    stream = (spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
              .selectExpr(*_split_select(EVENTS_DIRT)))
    q = conform_stream(spark, stream, EVENTS_SPEC, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    kept, dropped = settle(spark, EVENTS_SPEC, str(tmp_path / "out"))
    from trueform.operators.process import process
    res = process(spark.read.parquet(str(src)).selectExpr(*_split_select(EVENTS_DIRT)), EVENTS_SPEC)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, res.conformed.collect()))
    assert dropped.count() == res.dropped.where("drop_kind = 'duplicate'").count() > 0
