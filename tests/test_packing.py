import random

import pytest

from opinara.operators.packing import pack_batches


def serial(costs, limit=6000, overhead=800):
    batches, load = [], None
    number = 0
    for cost in costs:
        if load is None or load + cost > limit:
            number, load = number + 1, overhead + cost
        else:
            load += cost
        batches.append(number)
    return batches


def _check(spark, seqs, costs, parts=4, **sizes):
    data = list(zip(seqs, costs))
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "ingest_seq long, cost long").repartition(parts)
    got = {r["ingest_seq"]: (r["batch_no"], r["oversize"]) for r in pack_batches(df, **sizes).collect()}
    expected = dict(zip(seqs, serial(costs)))
    assert {seq: batch for seq, (batch, _) in got.items()} == expected
    assert {seq for seq, (_, big) in got.items() if big} == {s for s, c in data if c > 5200}


@pytest.mark.parametrize("chunk_rows, block_chunks", [(1, 1), (3, 2), (7, 3), (50, 4), (100000, 10)])
def test_equals_serial_walk(spark, chunk_rows, block_chunks):
    rng = random.Random(chunk_rows)
    costs = [rng.choice([50, 51, 60, 400, 1500, 5200, 5201, 9000, rng.randint(50, 900)]) for _ in range(400)]
    seqs = sorted(rng.sample(range(1200), 400))
    _check(spark, seqs, costs, chunk_rows=chunk_rows, block_chunks=block_chunks)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitioning_does_not_matter(spark, parts):
    rng = random.Random(5)
    costs = [rng.randint(50, 700) for _ in range(500)]
    _check(spark, range(500), costs, parts=parts, chunk_rows=64, block_chunks=2)


def test_many_tiny_records_cross_several_chunks(spark):
    _check(spark, range(300), [50] * 300, chunk_rows=10, block_chunks=3)


def test_nothing_in_nothing_out(spark):
    empty = spark.createDataFrame([], "ingest_seq long, cost long")
    assert pack_batches(empty).count() == 0


def test_ids_with_wide_gaps(spark):
    """The ids of many input splits: a few rows each, 2**33 apart."""
    rng = random.Random(3)
    seqs = [(part << 33) + place for part in range(40) for place in range(rng.randrange(1, 9))]
    _check(spark, seqs, [rng.randint(50, 2500) for _ in seqs])
