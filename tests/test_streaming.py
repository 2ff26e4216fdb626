from newsalpha.operators.embedding import hashing_embedder
from newsalpha.streaming.incremental import embed_arrived

SCHEMA = "rp_story_id bigint, headline string"


def test_only_arrived_files_are_embedded(spark, frame, tmp_path):
    source, output, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    frame([(1, "one"), (2, "two"), (2, "two")], SCHEMA).write.parquet(source)
    embed_arrived(spark, source, output, progress, hashing_embedder(8), SCHEMA)
    before = {r.rp_story_id: r.embedding for r in spark.read.parquet(output).collect()}
    assert set(before) == {1, 2}
    frame([(2, "two again"), (3, "three")], SCHEMA).write.mode("append").parquet(source)
    for _ in range(2):
        embed_arrived(spark, source, output, progress, hashing_embedder(8), SCHEMA)
    rows = spark.read.parquet(output).collect()
    assert sorted(r.rp_story_id for r in rows) == [1, 2, 3]
    assert all(r.embedding == before[r.rp_story_id] for r in rows if r.rp_story_id in before)
