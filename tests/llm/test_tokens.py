"""Token counts, byte-level BPE and packing against the libraries themselves."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from llm_fixtures import MESSY, SF, corpus, messy  # noqa: F401
from venuescope.llm import byte_bpe, packing, token_counts
from venuescope.llm.queries import QUERIES

ALL_IDS = [(i, t) for i, t, *_ in MESSY]


@pytest.fixture(scope="module")
def piece():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_token_counts_query(spark, corpus, piece):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    want = {}
    for d, t in corpus.itertuples(index=False):
        n = len(piece.encode(t))
        want[d] = (len(t.encode()), n, n > 4096)
    assert got == want


@pytest.mark.parametrize("entries", [0, 5, 1000])
def test_token_counts_messy(spark, messy, piece, entries):
    out = token_counts.count_tokens(messy, P.path("piece_bpe_32k.model"), entries=entries, room=3)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(d, len((t or "").encode()), len(piece.encode(t or "")), len(piece.encode(t or "")) > 4096) for d, t in ALL_IDS]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(messy.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_byte_bpe_query(spark, corpus, tik):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_byte_bpe"](spark, SF).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for d, t in corpus.itertuples(index=False):
        ids = tik.encode_ordinary(t)
        want[d] = (len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode()))
    assert got == want


def test_byte_bpe_messy_and_decode(spark, messy, tik):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = byte_bpe.encode(messy, path, P.PATTERN)
    got = sorted(((r.doc_id, r.ids) for r in enc.collect()), key=repr)
    assert got == sorted(((d, tik.encode_ordinary(t or "")) for d, t in ALL_IDS), key=repr)
    back = byte_bpe.decode(enc, path, P.PATTERN)
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in back.collect()), key=repr) == sorted(
        ((d, (t or "").encode()) for d, t in ALL_IDS), key=repr)
    assert byte_bpe.encode(messy.limit(0), path, P.PATTERN).count() == 0


def test_byte_bpe_random_pieces(tik):
    own = byte_bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, room=50)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("aabcehinrstu 's\n\té漢1"), size=n)) for n in [1, 2, 7, 40, 300, 1500] * 20]
    for t, raw in zip(texts, own.encode(texts)):
        assert np.frombuffer(raw, "<i4").tolist() == tik.encode_ordinary(t)


def check_packing(rows, want, capacity):
    """rows: (doc_id, piece, start, length, crc, sequence, offset); want: the ids of each document."""
    pieces = []
    for d, ids in want:
        pieces += [(d, k, a, len(ids[a:a + capacity]), zlib.crc32(np.array(ids[a:a + capacity], "<u4").tobytes()))
                   for k, a in enumerate(range(0, len(ids), capacity))]
    assert sorted((r[:5] for r in rows), key=repr) == sorted(pieces, key=repr)
    by = {}
    for r in rows:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for slots in by.values():
        at = 0
        for offset, n in sorted(slots):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


def best_fit(lengths, capacity):
    """Best fit decreasing, one piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, x in enumerate(room) if x >= n]
        if fit:
            room[min(fit, key=room.__getitem__)] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_packing_query(spark, corpus, word):
    rows = [tuple(r) for r in QUERIES["op4_packing"](spark, SF).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    want = [(d, word.encode(t, add_special_tokens=False).ids + [0]) for d, t in corpus.itertuples(index=False)]
    n = check_packing(rows, want, 2048)
    assert n == best_fit([r[3] for r in rows], 2048)


def test_packing_messy(spark, messy, word):
    from pyspark.sql import functions as F

    pieces = packing.token_pieces(messy, P.path("word_bpe_49k.json"), capacity=64)
    out = packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("_rank")), capacity=64)
    want = [(d, word.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in ALL_IDS]
    check_packing([tuple(r) for r in out.collect()], want, 64)
    empty = packing.pack(packing.token_pieces(messy.limit(0), P.path("word_bpe_49k.json")))
    assert empty.count() == 0 and {"sequence_id", "offset"} <= set(empty.columns)


def test_plan_is_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(30):
        cap = int(rng.integers(5, 60))
        lengths = rng.integers(1, cap + 1, size=int(rng.integers(1, 300))).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, bins = {}, set()
        for n, a, b, first, per, off in packing.plan(counts, cap):
            for r in range(a, b):
                seq, at = first + (r - a) // per, off + (r - a) % per * n
                used.setdefault(seq, []).append((at, n))
                bins.add(seq)
        assert sum(map(len, used.values())) == len(lengths)
        for slots in used.values():
            assert sum(n for _, n in slots) <= cap
            assert [a for a, _ in sorted(slots)] == np.cumsum([0] + [n for _, n in sorted(slots)])[:-1].tolist()
        assert len(bins) == best_fit(lengths, cap)
    assert packing.plan({}, 10) == []
    assert len(packing.plan({n: 10**12 for n in range(1, 2049)}, 2048)) < 200_000      # counts cost nothing


def test_long_pieces_take_seconds_and_equal_the_library():
    """Unbroken runs of letters, of one letter and of CJK characters: one piece each."""
    import random
    import time

    import tiktoken

    own = byte_bpe.Codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    library = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(1)
    runs = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(60000)), "a" * 100001, "".join(rng.choice("etaoinshrdlu") for _ in range(100000)),
            "\u6f22\u5b57" * 20000, "".join(rng.choice("ab") for _ in range(257))]
    start = time.perf_counter()
    ids = [np.frombuffer(x, "<i4") for x in own.encode(runs)]
    assert time.perf_counter() - start < 30
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in runs]
    assert own.decode(np.concatenate(ids), np.array([len(x) for x in ids])).to_pylist() == [t.encode() for t in runs]


class _NotWalked(dict):
    def __iter__(self):
        raise AssertionError("every word ever kept is walked")


def test_packing_plain_words_share_their_parts(word, monkeypatch):
    w = packing.Words(P.path("word_bpe_49k.json"))
    texts = ["There there. THERE, été Été! a1b22 <|x ÿ×÷Þ", "it's É́ <|endoftext|>x a\x1cb ΣΑΣ"]
    for t, raw in zip(texts, w.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == word.encode(t, add_special_tokens=False).ids
    assert w.young["there."] == w.young["there"] + w.young["."]
    # parts that are known need no library, and the old words are asked for by name
    monkeypatch.setattr(w, "_encode", lambda texts: [] if not texts else pytest.fail("tokenised again"))
    w.young, w.old = {}, _NotWalked(w.young)
    assert w.encode(["there! There, THERE"]) == [b"".join(w.young[p] for p in ("there", "!", "there", ",", "there"))]


class _Counted(dict):
    asked = 0

    def __getitem__(self, word):
        self.asked += 1
        return super().__getitem__(word)


def test_packing_asks_for_a_word_once_a_slice(word):
    """A column goes to Arrow as it is, and a word is looked up once however often the texts hold it."""
    import pyarrow as pa

    w = packing.Words(P.path("word_bpe_49k.json"))
    w.young = _Counted(w.young)
    texts = [" a b a  b\n" * 500, None, "", "a\x1fb a", "b" * 9 + "\x85a"]
    for part in (texts, texts[:3], texts[1:3]):
        want = [word.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [np.frombuffer(x, "<u4").tolist() for x in w.encode(pa.array(part, pa.string()))] == want
    # a part of a longer column
    assert w.encode(pa.array(texts, pa.string()).slice(4)) == w.encode(texts[4:])
    assert w.young.asked < 50


def test_packing_asks_for_a_part_once_a_slice(word):
    """New words are cut by Arrow: their parts are looked up once each, not once for every word."""
    w = packing.Words(P.path("word_bpe_49k.json"))
    w.young = _Counted(w.young)
    plain = [f"{a}{d}{b}{s}" for a in ("Ab", "cd", "\u00c0\u00d6") for d in "0123456789" for b in ("x", "YZ") for s in (",", "...", "!")]
    others = ["<|ENDOFTEXT|>", "<|EndOfText|>x", "x<|endoftext|>", "IT'S", "\u0130\u017f"]
    texts = [" ".join(plain[:90]), "", None, " ".join([*plain[60:], *others])]
    assert [np.frombuffer(x, "<u4").tolist() for x in w.encode(texts)] == [word.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert w.young.asked < len(plain) + 50
