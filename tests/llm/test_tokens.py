"""Token files and packing by exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterline.llm import packing, tokenfiles
from meterline.llm.tokens import Encoder
from meterline.session import scratch_path
from tests.llm.samples import documents, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoded(data):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, *_ in data]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_give_back_every_document_in_order(spark):
    path = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(documents(spark).withColumn("file", F.lit(1)), path, PATH)
    got = tokenfiles.read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, *_ in rows()), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    want = sorted((repr(i), len(ids), crc(ids)) for i, ids in encoded(rows()))
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_no_documents(spark):
    path = scratch_path(spark, "tokens")
    tokenfiles.write_tokens(documents(spark, []), path, PATH)
    assert tokenfiles.read_documents(spark, path).count() == 0
    assert packing.pack(documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("high", [1, 2, 50_257, 2**32])
@pytest.mark.parametrize("n", [1, 2, 1023, 1024])
def test_blocks_with_outliers(n, high):
    r = np.random.default_rng(n)
    ids = r.integers(0, max(1, high // 1000), n, dtype=np.uint64).astype(np.uint32)
    ids[n // 2] = high - 1
    assert (tokenfiles.decode_block(tokenfiles.encode_block(ids), n) == ids).all()


def test_any_part_of_a_segment():
    ids = np.random.default_rng(1).integers(0, 50_257, 5000, dtype=np.uint32)
    data = tokenfiles.encode_segment(ids, np.array([5000]))
    for start, n in ((0, 1), (1000, 100), (1023, 2), (4999, 1), (0, 5000)):
        assert (tokenfiles.read_ids(data, start, n) == ids[start : start + n]).all()
    with pytest.raises(ValueError):
        tokenfiles.decode_segment(b"XXXX" + data[4:])


def test_packing_puts_every_id_once_with_little_padding(spark):
    got = packing.pack(documents(spark).withColumn("offset", F.lit("mine")), PATH).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.context_size))
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for parts in sequences.values():
        at = 0
        for offset, length, size in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    padding = sum(max(s for *_, s in p) - sum(n for _, n, _ in p) for p in sequences.values())
    assert padding == 0
    sizes = {s for p in sequences.values() for *_, s in p}
    assert all(s in packing.TIERS or s & (s - 1) == 0 for s in sizes)
    want = defaultdict(list)
    for i, ids in encoded(rows()):
        want[i, len(ids)].append(ids)
    assert set(want) == set(pieces)
    for key, texts in want.items():
        assert sum(n for _, n, _ in pieces[key]) == key[1] * len(texts)
        for start, length, check in pieces[key]:
            assert check in {crc(ids[start : start + length]) for ids in texts}


def test_step_groups_hold_one_size(spark):
    groups = packing.pack(documents(spark), PATH, group_ids=4096).groupBy("step_group")
    for r in groups.agg(F.countDistinct("context_size").alias("sizes"), F.sum("length").alias("ids")).collect():
        assert r.sizes == 1 and r.ids <= 4096


def test_units_give_the_ids_of_whole_texts():
    r = random.Random(1)
    parts = ["\n", "\n\n", " ", "  ", "\t", "\r\n", "\x0b", "\x85", "\u00a0", "\u2028", "\u3000", "a", "foo", "bar.", ",", ".", "é",
             "×", "÷", "漢", "3", "12", "'s", "'", "-", "!,", "ª", "²", "١", "\u0301", "ʰ", "Ǆ", "🙂"]
    texts = ["foo\n\nbar", "a \n\n\nb", "c\t\n\nd", "ends  ", "x", "ends\n\n", "y", "\n", "\nz", ""]
    texts += ["".join(r.choices(parts, k=r.randint(1, 9))) for _ in range(20000)]
    data = [x.encode() for x in texts]
    ids, first = Encoder(PATH).encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    got = [ids[a:b].tolist() for a, b in zip(first, first[1:])]
    want = [x for _, x in encoded(zip(texts, texts))]
    assert [t for t, g, w in zip(texts, got, want) if g != w] == []


def test_words_go_to_the_library_without_marks():
    text = "The forest, as of then.\nÉté à la mer, année 2024!\nErste Zeile (neu)\nfin été\nwords" * 3
    encoder, marked = Encoder(PATH), []
    encoder._apart = lambda units, f=encoder._apart: marked.extend(units) or f(units)
    ids, first = encoder.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert ids.tolist() == encoded([(0, text)])[0][1] and first.tolist() == [0, len(ids)]
    assert set(marked) <= {b".\n", b"!\n", b")\n", b"\n"}


def test_any_new_units_give_their_own_ids():
    r = random.Random(2)
    ends = [b"", b" ", b"\n", b"\t", b"\xc2\xa0", b"\xe3\x80\x80", b"\xc3", b"\xa9", b"\xc3\xa9", b"'", b"'s", b"x", b"12", b"\xe6\xbc\xa2"]
    units = list({r.choice(ends) + r.choice([b"", b"word", b" two words", b"\n"]) + r.choice(ends) + r.choice(ends) for _ in range(4000)} - {b""})
    encoder = Encoder(PATH)
    ids, sizes = encoder._ids(units)
    want = [x.ids for x in encoder.plain.encode_batch([u.decode(errors="replace") for u in units], add_special_tokens=False)]
    ends = np.cumsum(sizes)
    assert [ids[b - n : b].tolist() for b, n in zip(ends, sizes)] == want


def test_segments_are_not_opened_block_by_block(monkeypatch):
    r = np.random.default_rng(3)
    ids = np.concatenate([r.integers(0, high, 2000, dtype=np.uint32) for high in (1, 2, 900, 50_257, 1 << 20)])
    ids[::97] = r.integers(0, 1 << 32, len(ids[::97]), dtype=np.uint64)
    blocks = [tokenfiles.encode_block(ids[a : a + tokenfiles.BLOCK]) for a in range(0, len(ids), tokenfiles.BLOCK)]
    data = tokenfiles.encode_segment(ids, np.array([4000, 6000]))
    assert data.endswith(b"".join(blocks))
    opened = []
    monkeypatch.setattr(tokenfiles, "decode_block", lambda *a, f=tokenfiles.decode_block: opened.append(a) or f(*a))
    got, sizes = tokenfiles.decode_segment(data)
    assert (got == ids).all() and sizes.tolist() == [4000, 6000]
    assert len(opened) == 1  # the last one, which is shorter


@pytest.mark.parametrize("room", [0, 2000, 1 << 28])
def test_units_are_known_again_whatever_their_length(monkeypatch, room):
    monkeypatch.setattr("meterline.llm.tokens.CACHE_BYTES", room)
    words = ["a", "a\0", "\0a", "\0\0", "a" * 7, "a" * 8, "b" + "a" * 7, "a" * 8 + "\0", "a" * 15, "a" * 16, "b" + "a" * 15, "a" * 17, "é" * 8, "a" * 300]
    encoder = Encoder(PATH)
    for k in range(4):
        texts = [" " + x + " " + y for x in words for y in (words[k], f"w{k}")] + [""]
        data = [x.encode() for x in texts]
        ids, first = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [x for _, x in encoded(zip(texts, texts))]
        assert encoder.held <= room
    if room > 2000:
        encoder._append = lambda units, at: pytest.fail(f"{units}") if any(len(x) < 200 for x in units) else Encoder._append(encoder, units, at)
        encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
