import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cooccur.llm import records
from cooccur.llm.queries import END_ID, tokenizer_path
from cooccur.llm.text import chunks
from cooccur.session import batch_bytes, fresh_path
from tests.llm.conftest import SCHEMA, words


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_give_the_ids_of_whole_texts(tokenizer):
    rng = np.random.default_rng(3)
    parts = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "'", "'s", ".", ",", "*", "1", "—", " ", "×", "日", "<|endoftext|>", "|", "\t", "\r\n", "\x85", "(", ")", " x", " the", "🙂"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)] + ["", " ", "\n"]
    own = records.PieceEncoder(tokenizer_path())
    for chunk in chunks(pa.array(texts), 4000):
        ids, ends = own.encode(chunk)
        at = 0
        for i, until in enumerate(ends.tolist()):
            assert ids[at:until].tolist() == tokenizer.encode(texts[chunk.first + i], add_special_tokens=False).ids
            at = until


def test_remembered_pieces_are_small_and_may_be_forgotten(tokenizer, monkeypatch):
    texts = [words(400, i) for i in range(200)]
    own = records.PieceEncoder(tokenizer_path())
    list(map(own.encode, chunks(pa.array(["one text"]))))
    tracemalloc.start()
    for chunk in chunks(pa.array(texts), 60000):
        own.encode(chunk)
    pieces = len(own.ends[own.ends > 0])
    del chunk
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert pieces > 40000 and held < 80 * pieces
    monkeypatch.setattr(records, "REMEMBERED", 3000)
    for chunk in chunks(pa.array(texts), 20000):
        ids, ends = own.encode(chunk)
        got = [a.tolist() for a in np.split(ids, ends)[:-1]]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[chunk.first: chunk.last]]


def test_round_trip(spark, odd, odd_rows, tokenizer):
    path = fresh_path(spark, "records")
    found = records.token_records(odd, tokenizer=tokenizer_path(), end_id=END_ID, path=path, files=3).collect()
    found.sort(key=lambda r: r["start"])
    want = sorted(((r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, END_ID]) for r in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in found] == [r[0] for r in want]
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in found) == sorted((len(ids), crc(ids)) for _, ids in want)
    shuffled = records.read_records(spark, path, seed=4).collect()
    assert sorted(map(repr, ((r["doc_id"], list(r["ids"])) for r in shuffled))) == sorted(map(repr, want))


def test_damage_is_found():
    data = bytearray(records.framed(7, np.array([1, 2, 3], "<u2")) + records.CLOSE)
    assert records.record_at(memoryview(bytes(data)), 0)[0] == 7
    data[20] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        records.record_at(memoryview(bytes(data)), 0)


def test_batches_to_tasks_are_bounded_inside_the_block_only(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = spark.range(3000).repartition(1).selectExpr("repeat('x', 1000) text").mapInArrow(sizes, "n long")
    with batch_bytes(spark, 1 << 17):
        inside = [r["n"] for r in found.collect()]
    assert sum(inside) == 3000 and max(inside) < 300
    assert [r["n"] for r in found.collect()] == [3000]


def test_empty(spark, empty):
    assert records.token_records(empty, tokenizer=tokenizer_path(), end_id=END_ID).count() == 0


def test_equal_ids_and_rows_fill_several_files(spark, tmp_path):
    """A third of the rows have no id, half of these one text."""
    rows = [(None, "same text" if i % 2 else words(20, i), "en", "s", 0) for i in range(900)] + [(i, words(20, i), "en", "s", 0) for i in range(1800)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = str(tmp_path / "records")
    found = records.token_records(docs, tokenizer=tokenizer_path(), end_id=2, path=path, files=12)
    per_file = [r["count"] for r in found.groupBy("file").count().collect()]
    assert sum(per_file) == 2700 and max(per_file) <= 2700 / 12 * 2.5
    assert found.where("doc_id is null").select("file").distinct().count() > 2
    ordered = found.orderBy("start").collect()
    assert [r["start"] for r in ordered] == [sum(x["n_tokens"] for x in ordered[:i]) for i in range(0, 2700)][:2700]
    assert [r["doc_id"] for r in ordered][900:] == list(range(1800))
