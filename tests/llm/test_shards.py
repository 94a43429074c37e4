import zlib
from collections import Counter, defaultdict

import pytest

from gridmart.llm import shards
from gridmart.llm.queries import op10_sampled_splitters

SCHEMA = "id long, group long, size long, shard string, name string"


def check(found, n):
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(n))
    return sizes


@pytest.mark.parametrize("rows_per_range", [50, 500_000])
def test_sizes_are_near_equal_whatever_the_groups(spark, rows_per_range):
    rows = [(i, i * 7919 % 10_007, 1 + i % 50, "x", f"n{i}") for i in range(3000)]
    rows += [(i, 77, 30, "x", f"n{i}") for i in range(3000, 4500)]  # a third are copies
    rows += [(9000, 5, 900, "x", "big")] + [(9001, 6, 10, "x", "same")] * 400
    found = shards.assign_shards(spark.createDataFrame(rows, SCHEMA).repartition(7), 16, rows_per_range).collect()
    assert sorted(r["name"] for r in found) == sorted(r[4] for r in rows)
    sizes = check(found, 16)
    mean = sum(sizes.values()) / 16
    assert all(abs(s - mean) <= 901 for s in sizes.values())
    of_group = defaultdict(set)
    for r in found:
        of_group[r["group"]].add(r["shard"])
    split = [g for g, held in of_group.items() if len(held) > 1]
    assert len(split) <= 15 and all(held == set(range(min(held), max(held) + 1)) for held in of_group.values())


def test_rows_in_every_state(spark):
    rows = [(None, None, None, "x", "a"), (1, None, 0, "x", "b"), (1, None, 0, "x", "b"), (2, 3, 10**12, "x", "c")]
    found = shards.assign_shards(spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert len(found) == 4
    check(found, 4)
    assert shards.assign_shards(spark.createDataFrame([], SCHEMA), 4).count() == 0


def test_the_query_against_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = op10_sampled_splitters(spark, folder).collect()
    plain = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == plain
    sizes, slots, shards_of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in found:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        shards_of[r["text_crc32"], r["size"]].add(r["shard"])
    assert sorted(sizes) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 16
    assert all(abs(s - mean) <= max(size for _, size, _ in plain) for s in sizes.values())
    # equal texts stay together but where a range had to be divided
    assert sum(len(s) > 1 for s in shards_of.values()) <= 15
