import zlib

from quotalens.llm import sharding


def brute(pairs, shards):
    """Rows in order, each with the shard that holds its middle, numbered within the shard."""
    rows = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    total, at, out, seen = sum(r[1] for r in rows), 0, [], {}
    for i, size, crc in rows:
        shard = (2 * at + size) * shards // (2 * total)
        out.append((i, size, crc, shard, seen.setdefault(shard, 0)))
        seen[shard] += 1
        at += size
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, *[x or 0 for x in r]))


def test_equal_to_brute_force(spark, edge, small, empty):
    for docs in (edge, small):
        pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        for shards in (1, 3, 8):
            got = [tuple(r) for r in sharding.shard(docs, shards).collect()]
            assert ordered(got) == ordered(brute(pairs, shards))
    assert sharding.op13(empty).count() == 0


def test_sizes_are_near_equal_and_slots_gapless(spark):
    docs = spark.range(0, 5000, 1, 7).selectExpr("id as doc_id", "repeat('é', int(id % 40)) as text")
    rows = sharding.op13(docs).collect()
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    sums, slots = {}, {}
    for r in rows:
        sums[r.shard] = sums.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(sums) == list(range(8)) and max(sums.values()) - min(sums.values()) <= 2 * 79
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    last = {s: max(r.doc_id for r in rows if r.shard == s) for s in range(8)}
    assert all(r.doc_id > last[r.shard - 1] for r in rows if r.shard)  # contiguous


def test_one_key_of_all_rows_is_spread(spark):
    docs = spark.range(0, 20_000, 1, 8).selectExpr("cast(null as long) as doc_id", "'same' as text")
    rows, total = sharding.prefix_sums(sharding.sizes(docs))
    assert total == 100_000 and rows.select("number").distinct().count() == 20_000
    own = sharding.sizes(docs).withColumn("_row", sharding.F.monotonically_increasing_id()) \
        .repartitionByRange(8, *sharding.ORDER)
    sizes = [r[1] for r in own.groupBy(sharding.F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5000
