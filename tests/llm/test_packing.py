"""Packing: ids against the library, whole coverage, and the number of sequences against its bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gatelake.llm import packing
from gatelake.llm.queries import QUERIES, TOKENIZER, tokenizer_file
from tests.llm.data import awkward, frame, prose, texts

SOURCE = tokenizer_file(TOKENIZER)
LIBRARY = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
SF = "/root/testdata/sf0.001"


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


ODD = [
    "it's <|endoftext|> here", "a  b   c\n\n d\t e ", "   x y ", "naïve ÉCOLE ½ ٣ 日本語 \U0001f600", "x" * 5000, "\x1c!\x1d \x85.", " lead", "trail ", "''s'll", "",
]


def test_ids_equal_the_librarys():
    encoder = packing.Encoder(SOURCE)
    assert encoder._fast is not None
    for t in ODD + [t for _, t in texts() if t]:
        assert encoder.encode(t).tolist() == ids_of(t)[:-1]


def test_long_texts_are_encoded_in_parts(monkeypatch):
    encoder = packing.Encoder(SOURCE)
    monkeypatch.setattr(packing, "CHUNK_CHARS", 7)
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choice("ab1!' \n\t  \x1c\x85é.") for _ in range(r.randint(0, 60)))
        assert encoder.encode(t).tolist() == ids_of(t)[:-1], t


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_tokenizers_run_by_the_library(name):
    source, lib = tokenizer_file(name), Tokenizer.from_file(public_tokenizers.path(name))
    encoder = packing.Encoder(source)
    assert encoder._fast is None
    assert encoder.encode("Some Words, here.").tolist() == lib.encode("Some Words, here.", add_special_tokens=False).ids


def test_cut():
    for n in (1, 3, 4, 5, 8, 9):
        ids = np.arange(n, dtype="<u4").tobytes()
        parts = packing.cut(ids, 4)
        assert b"".join(p for _, _, p in parts) == ids and [i for i, _, _ in parts] == list(range(len(parts)))
        assert [s for _, s, _ in parts] == [0, *np.cumsum([len(p) // 4 for _, _, p in parts])[:-1]]
        assert all(len(p) == 16 for _, _, p in parts[1:]) and 0 < len(parts[0][2]) <= 16


def test_best_fit_takes_the_smallest_gap():
    r = random.Random(2)
    for _ in range(50):
        sizes = [r.randint(1, 20) for _ in range(r.randint(0, 60))]
        gaps = []
        for s in sorted(sizes, reverse=True):
            fit = [g for g in gaps if g >= s]
            gaps.remove(min(fit)) if fit else None
            gaps.append((min(fit) if fit else 20) - s)
        bins = packing.best_fit(sizes, 20)
        assert sorted(20 - sum(sizes[i] for i in b) for b in bins) == sorted(gaps)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))


def whole(got, docs, capacity):
    """Every piece of every document once, its ids right, its sequence full without gaps."""
    want = Counter()
    for doc_id, text in docs:
        ids = ids_of(text)
        first = len(ids) % capacity or min(len(ids), capacity)
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[doc_id, i, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in got)


def test_pack_is_whole_and_tight(spark):
    docs = awkward() + texts() + [(9000 + i, t) for i, t in enumerate(ODD)]
    for parts, capacity in ((1, 2048), (7, 2048), (5, 100)):
        packed = packing.pack(frame(spark, docs).repartition(parts), SOURCE, capacity=capacity)
        n, total = whole(packing.pieces(packed).collect(), docs, capacity)
        assert n == packed.count()
        sizes = [len(ids_of(t)) % capacity or capacity for _, t in docs]
        whole_pieces = sum((len(ids_of(t)) - 1) // capacity for _, t in docs)
        # one task would take so many; the tree may lose a sequence or two
        assert n <= whole_pieces + len(packing.best_fit(sizes, capacity)) + 2
        assert n >= -(-total // capacity)


def test_rounds_in_bounded_memory(spark, monkeypatch):
    r = random.Random(4)
    items = [(n, [(i, 0, 0, b"\0" * 4 * n)]) for i, n in enumerate(r.choice([5, 30, 60, 90]) for _ in range(2000))]
    monkeypatch.setattr(packing, "BUFFER_BYTES", 4000)
    bins = list(packing._round(iter(items), 100, 2))
    assert sorted(m[0] for _, (_, ms) in bins for m in ms) == list(range(2000))
    assert all(sum(len(m[3]) for m in ms) == 4 * load and load <= 100 and done == (load > 98) for done, (load, ms) in bins)


def test_tree_merges_underfull_bins(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUFFER_BYTES", 3000)
    docs = [(i, prose(r, i)) for i, r in enumerate([3, 5, 8, 13, 20, 31] * 40)]
    for k in (1, 16):
        n, total = whole(packing.pieces(packing.pack(frame(spark, docs).repartition(k), SOURCE, capacity=100)).collect(), docs, 100)
        assert n <= 1.1 * total / 100 + 3


def test_documents_that_never_fit_together(spark):
    docs = [(i, "word " * 60) for i in range(40)]
    packed = packing.pack(frame(spark, docs).repartition(4), SOURCE, capacity=100)
    n, _ = whole(packing.pieces(packed).collect(), docs, 100)
    assert n == 40


def test_sequences_hold_their_members(spark):
    packed = packing.pack(frame(spark, texts()).repartition(3), SOURCE)
    for r in packed.select("load", "members", packing.sequence_ids().alias("ids")).collect():
        assert bytes(r["ids"]) == b"".join(bytes(m["ids"]) for m in r["members"]) and len(r["ids"]) == 4 * r["load"]


def test_query(spark):
    docs = [(i - 100000, t) for i, t in texts()]
    got = QUERIES["op13_best_fit_packing"](spark, SF).collect()
    want = {}
    for doc_id, text in docs:
        for piece, start, part in packing.cut(np.array(ids_of(text), "<u4").tobytes(), 2048):
            want[doc_id, piece] = (start, len(part) // 4, zlib.crc32(part))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want


def test_empty_table(spark):
    packed = packing.pack(frame(spark, []), SOURCE)
    assert packed.count() == 0 and packing.pieces(packed).count() == 0
