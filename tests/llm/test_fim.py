"""Fill-in-middle: frames, cuts and round trips against a plain version."""

import hashlib
import random
import re

import pytest
import zstandard

from gatelake.llm import fim
from tests.llm.data import awkward, frame, texts


def plain(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def rows():
    r = random.Random(5)
    odd = ["\n", "\n\n\n", "no end", "a\nb", "a <P> b\nc\n", "x <M>", "<S", "<P\n<S\n<M", "é\n日本\n\U0001f600", "\r\n\x85 \n"]
    long = ["".join(r.choice("ab é\n" if i % 2 else "abcdefgh" * 9 + "\n") for _ in range(fim.FRAME_CHARS * 3 + r.randint(-2, 2))) for i in range(12)]
    edge = ["x" * (fim.FRAME_CHARS - 1) + "\n" + "y\n" * 5, "x" * fim.FRAME_CHARS + "\n", "z" * (2 * fim.FRAME_CHARS), "\n" * (2 * fim.FRAME_CHARS)]
    return awkward() + texts() + [(5000 + i, t) for i, t in enumerate(odd + long + edge)] + [(k, edge[0]) for k in range(6000, 6040)]


def test_frames_give_the_transformed_texts(spark):
    docs = frame(spark, rows()).repartition(4)
    got = fim.fill_in_middle(docs).collect()
    assert len(got) == len(rows())
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    want = sorted(((i, *plain(i, t)) for i, t in rows()), key=key)
    have = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], fim.read(r["output"])) for r in got), key=key)
    assert have == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    # the frames joined are one zstandard stream
    r = max(got, key=lambda r: len(r["output"]))
    stream = zstandard.ZstdDecompressor().stream_reader(b"".join(r["output"]), read_across_frames=True)
    assert stream.read().decode() == fim.read(r["output"])


def test_digests_restore_every_text(spark):
    docs = frame(spark, rows()).repartition(3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {(r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in fim.digests(fim.fill_in_middle(docs)).collect()}
    assert got == {(i, sha(plain(i, t)[4]), sha(t or "")) for i, t in rows()}


@pytest.mark.parametrize("rate,spm", [(0, 50), (40, 0), (100, 100)])
def test_rates(spark, rate, spm):
    docs = frame(spark, texts())
    got = {r["doc_id"]: (r["form"], fim.read(r["output"])) for r in fim.fill_in_middle(docs, rate=rate, spm_rate=spm).collect()}
    assert got == {i: (plain(i, t, rate, spm)[1], plain(i, t, rate, spm)[4]) for i, t in texts()}


def test_only_cut_frames_are_read():
    text = "line of text\n" * 40_000
    packer, reader = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    framed = fim.Framed(fim.to_frames(text, packer), packer, reader)
    n = fim.n_units(framed.frames, False)
    cuts = [framed.cut(k, n) for k in (9_000, 30_000)]
    assert len(framed.frames) > 10 and framed.n_read == 2
    parts = [framed.between(a, b) for a, b in zip([(0, 0, 0), *cuts], [*cuts, (len(framed.frames), 0, 0)])]
    assert framed.n_read == 2
    assert [fim.read(p) for p in parts] == ["line of text\n" * k for k in (9_000, 21_000, 10_000)]


def test_empty_table(spark):
    assert fim.digests(fim.fill_in_middle(frame(spark, []))).count() == 0
