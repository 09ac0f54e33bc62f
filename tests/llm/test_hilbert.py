import itertools
import zlib

import numpy as np
import pytest

from sitecharge.llm.hilbert import curve_index, sharded, write_shards


@pytest.mark.parametrize("dimensions, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_table(messy, messy_documents):
    rows = sharded(messy_documents, shards=7).collect()
    plain = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in messy]
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == sorted(plain, key=repr)
    counts = [sorted(r.slot for r in rows if r.shard == s) for s in range(7)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    order = sorted((r.shard, r.slot, r.curve) for r in rows)
    assert [c for *_, c in order] == sorted(c for *_, c in order)


def test_few_rows_and_none(messy_documents, documents):
    assert sharded(messy_documents.limit(0)).count() == 0
    few = sharded(documents([(i, "x", "en", "a", 1) for i in range(5)])).collect()
    assert all(r.slot == 0 for r in few) and len({r.shard for r in few}) == 5


def test_files(spark, messy, messy_documents, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(messy_documents, path, shards=5)
    back = spark.read.parquet(path)
    assert set(messy_documents.columns) <= set(back.columns)
    assert sorted(map(repr, (r.doc_id for r in back.collect()))) == sorted(repr(i) for i, *_ in messy)
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 4  # equal rows may stay together
