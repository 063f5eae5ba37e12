"""Operators 5, 6 and 10: placement laws, and exact round trips of the file formats."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vitrine.llm import op5_sharding as sharding, op6_warc as warc, op10_simple8b as s8b, subwords
from vitrine.llm.frames import read_files
from vitrine.llm.subwords import json_encoder, rank_encoder
from vitrine.session import scratch_path


def test_growth_moves_slots_only_to_the_new_shard():
    owners = sharding.grown_map(24)
    grown = sharding.grow(owners, 24)
    moved = [(a, b) for a, b in zip(owners, grown) if a != b]
    assert {b for _, b in moved} == {24}
    sizes = Counter(grown)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 25
    assert max(Counter(owners).values()) - min(Counter(owners).values()) <= 1


def test_rebalancing_evens_out_bytes_and_moves_few():
    owners = sharding.grown_map(8, 512)
    size = {s: 100 + (5000 if owners[s] == 3 else 0) for s in range(512)}
    out = sharding.rebalance(owners, 8, size)
    load = Counter()
    for s, shard in enumerate(out):
        load[shard] += size[s]
    assert max(load.values()) <= 1.05 * sum(load.values()) / 8
    assert {owners[s] for s in range(512) if owners[s] != out[s]} == {3}


def test_sharding_query(session):
    sf = "/root/testdata/sf0.001"
    got = sharding.op5_virtual_slots(session, sf).collect()
    docs = {r.doc_id: r.text for r in session.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs.items()}
    assert all(r.law == "key" and (r.grown_shard == r.shard or r.grown_shard == 24) and 0 <= r.shard < 24 for r in got)
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    held = Counter()
    for r in got:
        held[r.balanced_shard] += r.size
    grown = Counter()
    for r in got:
        grown[r.shard] += r.size
    assert max(held.values()) - min(held.values()) < max(grown.values()) - min(grown.values())
    slots = {r.virtual_slot: (r.shard, r.balanced_shard) for r in got}
    assert all(slots[r.virtual_slot] == (r.shard, r.balanced_shard) for r in got) and sum(a != b for a, b in slots.values()) < len(slots)
    larger = {r.doc_id: r.shard for r in sharding.op5_virtual_slots(session, "/root/testdata/sf0.01").collect()}
    assert all(larger[r.doc_id] == r.shard for r in got)


def test_sharding_odd_rows(session, odd, empty):
    path = scratch_path(session, "map")
    sharding.save_map(session, path, "3", sharding.grown_map(3))
    slot_map = sharding.load_map(session, path, "3")
    got = sharding.numbered(sharding.place(odd, slot_map)).collect()
    assert len(got) == odd.count() and sum(r.size == 8 for r in got) == 3
    assert sharding.place(empty, slot_map).count() == 0
    sizes = {r.virtual_slot: (r.rows, r.bytes) for r in sharding.slot_sizes(sharding.place(odd, slot_map)).collect()}
    assert sum(r for r, _ in sizes.values()) == odd.count()


def pages(session):
    shared = "<p>" + "shared text " * 20
    rows = [(3, "u3", shared), (1, "http://x/ \r\n?q=ü", shared), (2, None, shared), (4, "u", "short"), (5, "u", "short"), (6, None, None), (7, "u", ""), (None, "u", shared), (8, "u", "é" * 49), (9, "u", "é" * 49), (10, "u", "é" * 50), (11, "u", "é" * 50)]
    rows += [(100 + i, f"u{i}", f"<html><body>page {i} " + "common words of a page " * (i % 40)) for i in range(200)]
    rows += [(500, "u", "z" * 3_000_000)]
    return session.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(2)


def test_warc_round_trip(session):
    frame, path = pages(session), scratch_path(session, "warc")
    warc.write_archives(frame, path)
    got = Counter((int(r.page_id) if r.page_id else None, r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None) for r in warc.read_archives(session, path).collect())
    con = duckdb.connect()
    frame_rows = [(r.page_id, r.html) for r in frame.collect()]
    con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", frame_rows)
    assert got == Counter(con.execute(warc.SQL).fetchall())
    files = [bytes(r.content) for r in read_files(session, path).collect()]
    assert any(f[:4] == warc.struct.pack("<I", warc.DICTIONARY_FRAME) for f in files)
    assert sum(len(list(warc.read_records(f))) for f in files) == len(frame_rows)


def test_warc_records_need_only_the_dictionary_and_their_frame():
    records = [warc.record(i, f"http://x/{i}", b"payload of a page " * 30, hashlib.sha256(b"payload of a page " * 30).hexdigest(), None) for i in range(50)]
    chunks = list(warc.archive_chunks(iter(records)))
    size = int.from_bytes(chunks[0][4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(chunks[0][8 : 8 + size])
    assert zstandard.ZstdDecompressor(dict_data=dictionary).decompress(chunks[31][: -len(warc.PAD)]) == records[30]
    assert list(warc.archive_chunks(iter([]))) == []
    with pytest.raises(ValueError):
        list(warc.read_records(b"no archive at all"))


def test_warc_empty(session):
    path = scratch_path(session, "warc")
    warc.write_archives(pages(session).filter("false"), path)
    assert warc.read_archives(session, path).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), min_size=1, max_size=400))
def test_simple8b_words(values):
    ids = np.array(values, dtype=np.uint64)
    words, escapes = s8b.pack(ids)
    assert (s8b.unpack(words, escapes, len(ids)) == ids).all()
    assert len(escapes) == sum(v >= 1 << 60 for v in values)


def test_simple8b_packs_as_many_as_fit():
    for value, count in ((0, 60), (1, 60), (3, 30), (1000, 6), (20_000, 4), (50_256, 3), (1 << 25, 2), (1 << 40, 1)):
        assert len(s8b.pack(np.full(count, value, dtype=np.uint64))[0]) == 1
        assert len(s8b.pack(np.full(count + 1, value, dtype=np.uint64))[0]) == 2


def test_blocks_split_long_documents():
    docs = [(1, np.arange(200_000) % 50_000), (None, np.array([2])), (3, np.arange(5))]
    docs = [(i, x.astype(np.uint32)) for i, x in docs]
    content = b"".join(b + b"\n" for b in s8b.blocks(docs))
    back = defaultdict(list)
    for doc, first, total, ids in s8b.read_blocks(content):
        assert first == sum(map(len, back[doc]))
        back[doc].append(ids)
    assert [(i, np.concatenate(back[i]).tolist()) for i, _ in docs] == [(i, x.tolist()) for i, x in docs]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(1 << 60, 2**64 - 1)), min_size=1, max_size=3000), st.integers(0, 3100), st.integers(0, 3100))
def test_a_range_of_a_block_is_read_by_its_marks(values, first, count):
    ids = np.array(values * 3, dtype=np.uint64)
    content = s8b.block([(1, 0, len(ids), len(ids))], ids) + b"\n"
    (block,) = s8b.file_blocks(content)
    assert block.range(first, count).tolist() == ids[first : first + count].tolist()


def test_a_range_of_a_file_reads_only_its_words(monkeypatch):
    docs = [(i, ((np.arange(50_000) * (i + 7)) % 50_000).astype(np.uint32)) for i in range(6)]
    content = b"".join(b + b"\n" for b in s8b.blocks(docs))
    every = np.concatenate([x for _, x in docs]).tolist()
    whole, seen = s8b.unpack, []
    monkeypatch.setattr(s8b, "unpack", lambda words, *rest: seen.append(len(words)) or whole(words, *rest))
    for first, count in ((0, 10), (65_530, 20), (131_000, 70_000), (299_990, 50), (300_000, 5), (17, 0)):
        seen.clear()
        assert s8b.read_range(content, first, count).tolist() == every[first : first + count]
        assert sum(seen) <= count + 4 * s8b.MARK


def expected(rows):
    reader = Tokenizer.from_file(public_tokenizers.path(s8b.TOKENIZER))
    reader.encode_special_tokens = True
    return [(i, reader.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]


def test_token_files(session, documents, odd, empty):
    frame = documents.select("doc_id", "text").filter("doc_id < 60").union(odd.selectExpr("doc_id + 1000 AS doc_id", "text"))
    got = sorted(s8b.encode(frame).collect(), key=lambda r: r.start)
    want = expected([(r.doc_id, r.text) for r in frame.collect()])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for i, x in want)
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert s8b.encode(empty).count() == 0


def test_whole_ids_are_read_back(session, odd):
    path = scratch_path(session, "ids")
    s8b.write_ids(odd, path)
    got = Counter((r.doc, tuple(r.ids)) for r in s8b.read_ids(session, path).collect())
    assert got == Counter((None if i is None else str(i), tuple(x)) for i, x in expected([(r.doc_id, r.text) for r in odd.collect()]))


def test_memory_of_pieces_is_bounded_where_ids_are_zipped_to_rows(monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 100)
    monkeypatch.setattr(subwords, "REMEMBERED_TAILS", 10, raising=False)
    shared = json_encoder(s8b.TOKENIZER)
    coder = subwords.PieceEncoder(shared.encode, shared.lengths, shared.word)
    for n in range(4):
        rows = [(i, " ".join(f"w{'abcdefghij'[j]}{'xyzé'[n]}{'klmnopqrst'[i]}q{'.,!?'[j % 4] * (j + n)}" for j in range(10)) + " an end, of it" * n) for i in range(10)]
        got = list(zip([i for i, _ in rows], coder.strings(pa.array([t for _, t in rows]), 2)))
        assert [(i, x.tolist()) for i, x in got] == expected(rows)
    assert len(coder.known) <= 100 and len(coder.tails) <= 10


@pytest.mark.parametrize("encoder", [lambda: json_encoder(s8b.TOKENIZER), lambda: rank_encoder("byte_bpe_50k.tiktoken")])
def test_pieces_encode_like_whole_texts(encoder):
    texts = ["a  b", "x \n y", "é　 q", " lead", "trail ", "a\tb c", "it's 's fine", "\x1c a b\x85 c", "", " ", "a <|endoftext|> b", "  two", "word " * 50 + "x" * 100, "a   b c", "1 2  3 four!! *** (five)",
             "an end.\nBegin, of\nlines\n\ntwo. naïve,\nÉté!\n a_b don't x's éa's <b>c</b> w/o _ ª º² ½x x½ Straße. ØÆ! ends.\r\nNext ...and --so \"it\" (is) [a] {b} ~c c~\nd~ e\u0301a\nb\u0301"]
    assert [(None, x.tolist()) for x in encoder().texts(texts, 2)] == expected([(None, t) for t in texts])
