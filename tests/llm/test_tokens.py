import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from lakeshard.llm import bpe, chunks, huffman, token_scan, tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["", "   ", "a\x1cb c\x1d d", "Σίσυφος ΟΔΥΣΣΕΥΣ", "İstanbul é ́x", "it's don't WE'LL 'S 'TIS",
        "<|startoftext|>hi<|endoftext|> x <|endoftext|>", "日本語 テスト 123 ४५", "😀😀 a😀b", " x y　z", "ﬁ ǅ ß ẞ",
        "a" * 900, "\x00\x01 \x7f", "a\n\n b  c\t\td ", " \x85x\xa0y z  \n", "\x1c \x1c", "abab" * 200, "thethethe ofofof"]

pytestmark = pytest.mark.skipif(not os.path.exists(WORDS), reason="vocabulary files are not here")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def _texts(rows):
    return [r[1] or "" for r in rows] + HARD


def test_bpe_equals_the_library(library, odd_rows):
    texts, model = _texts(odd_rows), bpe.WordBpe(WORDS)
    ids, counts = model.encode([None, *texts])
    assert counts[0] == 0
    names = model.decode(ids, counts)
    for text, got, name, want in zip(texts, np.split(ids, np.cumsum(counts)[:-1])[1:], names[1:],
                                     library[WORDS].encode_batch(texts, add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids, text[:80]
        assert name.decode() == library[WORDS].decode(want.ids, skip_special_tokens=False)


def test_bpe_backtracking_alone_equals_the_library(library, words):
    model = bpe.WordBpe(WORDS)
    for w in words:
        symbols = model._words(w)[0]
        assert model.backtrack(symbols) == library[WORDS].encode(w, add_special_tokens=False).ids


def test_bpe_caches_that_overflow(library, odd_rows, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 20)
    monkeypatch.setattr(bpe, "PAIRS", 10)
    model = bpe.WordBpe(WORDS, limit=30)
    for r in odd_rows[:60]:
        assert model.encode([r[1]])[0].tolist() == library[WORDS].encode(r[1] or "", add_special_tokens=False).ids


def test_bpe_digests_and_round_trip(odd, odd_rows, none, library):
    tok, want = library[WORDS], Counter()
    for r in odd_rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(odd, WORDS).collect())) == want
    encoded = bpe.encode(odd, WORDS)
    assert Counter((r["doc_id"], len(r["ids"])) for r in encoded.collect()) == Counter((i, n) for i, n, _, _ in want.elements())
    decoded = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in bpe.decode(encoded, WORDS).collect())
    assert decoded == Counter((i, d) for i, _, _, d in want.elements())
    assert bpe.digests(none, WORDS).count() == 0


def test_library_pieces_equal_whole_texts(library, odd_rows):
    texts = _texts(odd_rows)
    for special in (True, False):
        enc = tokens.LibraryEncoder(BYTES, special, limit=50)
        tok = library[BYTES]
        tok.encode_special_tokens = not special
        for at in range(0, len(texts), 7):
            ids, counts = enc.encode(texts[at:at + 7])
            for got, want in zip(np.split(ids, np.cumsum(counts)[:-1]), tok.encode_batch(texts[at:at + 7], add_special_tokens=False), strict=True):
                assert got.tolist() == want.ids
        tok.encode_special_tokens = False


def test_pieces_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(chunks, "_ONE", chunks._ONE * 0)
    cache = chunks.ChunkCache(lambda new: [np.array([len(c), ord(c[-1])], np.int32).tobytes() for c in new])
    for texts in (["aa bb", "cc"], ["dd", None, "", "aa"]):
        ids, counts = cache.encode(texts)
        want = [[2, ord(t[1])] if len(t) == 2 else [2, ord("a"), 3, ord("b")] if t else [] for t in (t or "" for t in texts)]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


@pytest.mark.parametrize("limit", [8, 12, 16])
def test_code_lengths_are_prefix_codes_and_optimal(limit):
    rng = np.random.default_rng(limit)
    counts = rng.zipf(1.5, 200).clip(0, 10**9)
    counts[rng.random(200) < 0.2] = 0
    lengths = huffman.code_lengths(counts, limit)
    used = lengths[lengths > 0]
    assert ((lengths > 0) == (counts > 0)).all() and used.max() <= limit
    assert (2.0 ** -used.astype(float)).sum() <= 1
    free = huffman.code_lengths(counts, 30)
    assert (counts * lengths).sum() >= (counts * free).sum()
    p = counts[counts > 0] / counts.sum()
    assert (counts * free).sum() / counts.sum() < -(p * np.log2(p)).sum() + 1


def test_coder_round_trip_with_checkpoints():
    for alphabet in (1, 2, 700, 200_000):
        rng = np.random.default_rng(alphabet)
        counts = rng.integers(1, 1000, alphabet)
        coder = huffman.Coder(huffman.code_lengths(counts))
        runs = np.array([0, 1, huffman.CHECK - 1, huffman.CHECK, huffman.CHECK + 1, 3000, 0, 5])
        ids = rng.integers(0, alphabet, runs.sum())
        payload, checks = coder.encode(ids, runs)
        at = np.cumsum([0, *map(len, payload)])[:-1] * 8
        assert np.array_equal(coder.decode(b"".join(payload), np.concatenate([c + o for c, o in zip(checks, at, strict=True)]), runs), ids)


@pytest.mark.parametrize("range_bytes", [1 << 24, 3000])
def test_huffman_files(spark, odd, odd_rows, library, tmpdir_path, monkeypatch, range_bytes):
    monkeypatch.setattr(huffman, "RANGE_BYTES", range_bytes)
    path = f"{tmpdir_path}/huffman"
    got = huffman.round_trip(odd, BYTES, size=50257, path=path).collect()
    rows = sorted(((r[0], library[BYTES].encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in odd_rows),
                  key=lambda x: (x[0] is not None, x[0] or 0))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in rows)
    # in order of the ids, the starts are the sums before; rows with equal ids stand next to each other
    at = 0
    for r, (i, _) in zip(sorted(got, key=lambda r: r["start"]), rows, strict=True):
        assert (r["doc_id"], r["start"]) == (i, at)
        at += r["n_tokens"]
    read = Counter((r["doc_id"], tuple(r["ids"])) for r in huffman.read(spark, path).collect())
    assert read == Counter((i, tuple(x)) for i, x in rows)


def test_huffman_ranges_split_null_ids_and_equal_rows(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(huffman, "RANGE_BYTES", 500)
    rows = [(7, "one row many times")] * 1000 + [(None, f"null {i % 300}") for i in range(1000)] + [(i, f"text {i}") for i in range(8, 1008)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = f"{tmpdir_path}/hot"
    got = sorted(huffman.round_trip(docs, BYTES, size=50257, path=path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 1000 + [7] * 1000 + list(range(8, 1008))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    parts = [r["count"] for r in huffman.read(spark, path).groupBy("part").count().collect()]
    assert len(parts) >= 10 and max(parts) < 600


def test_huffman_of_nothing(none):
    assert huffman.round_trip(none, BYTES, size=50257).count() == 0


@pytest.mark.parametrize("block", [1, 50, 1 << 18])
def test_separator_scan(odd, odd_rows, none, library, block):
    if block == 1:
        odd_rows = [r for r in odd_rows if len(r[1] or "") < 200]
        odd = odd.where("text IS NULL OR length(text) < 200")
    tok = library[BYTES]
    tok.encode_special_tokens = True
    want = Counter((r[0], len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    tok.encode_special_tokens = False
    got = token_scan.token_counts(odd, BYTES, block_ids=block).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    files = defaultdict(list)
    for r in got:
        files[r["file"]].append((r["ordinal"], r["start"], r["n_tokens"]))
    for rows in files.values():
        at = 0
        for k, (ordinal, start, n) in enumerate(sorted(rows)):
            assert (ordinal, start) == (k, at)
            at += n + 1
    assert token_scan.token_counts(none, BYTES).count() == 0


def test_separator_in_a_text_is_text_and_open_ends_show(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "c")], "doc_id long, text string").coalesce(1)
    token_scan.write_flat(docs, BYTES, f"{tmpdir_path}/flat", block_ids=3)
    assert [r["complete"] for r in token_scan.scan(spark, f"{tmpdir_path}/flat").collect()] == [True, True]
    rows = spark.read.parquet(f"{tmpdir_path}/flat").where("kind = 'ids'").orderBy("seq").collect()
    cut = [r for r in rows][:-1]
    spark.createDataFrame(cut, "file int, seq int, first long, payload binary, kind string").write.partitionBy("kind").parquet(f"{tmpdir_path}/cut")
    got = token_scan.scan(spark, f"{tmpdir_path}/cut").collect()
    flat = np.concatenate([np.frombuffer(r["payload"], "<u2") for r in cut])
    assert sum(r["n_tokens"] + r["complete"] for r in got) == len(flat)
    assert [r for r in got if not r["complete"]]
