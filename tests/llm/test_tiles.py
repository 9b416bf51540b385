"""Tiles multiply few bits, and rule out no pair that the whole bags leave."""

import random

import numpy as np
import pyarrow as pa

from sparkloom.llm import segments as S
from tests.llm.test_history_and_splits import edited, sentence


def block(texts):
    """A block of texts that all ask and answer, as every_candidate makes it."""
    kept, codes, lengths = S._kept(texts, S.MIN_CHARS)
    m = S._hashes(codes, lengths)[0]
    first = np.cumsum(lengths) - lengths
    letters, digits = (np.add.reduceat((codes >= lo) & (codes <= hi), first, dtype=np.int64) for lo, hi in ((97, 122), (48, 57)))
    alike = (letters * S.LATIN >= lengths) | (lengths >= 2 * S.SHORT_BAG)
    cols = {"id": kept, "len": lengths, "letters": letters, "digits": digits, "ask": np.full(len(kept), 1), "answer": np.zeros(len(kept), int), "side": np.full(len(kept), 2)}
    bags = {"bag": pa.array(S._ones(m, lengths), pa.binary()), "twos": pa.array(S._twos(m, lengths, alike), pa.binary())}
    return pa.table({k: pa.array(v) for k, v in cols.items()} | bags)


def left(table):
    """Pairs of ids that the bags over all bits leave."""
    n, bits = table.num_rows, int(S._bag_bits(table.column("len").to_numpy()).min())
    about = np.stack([table.column(c).to_numpy() for c in ("len", "letters", "digits")])
    of = lambda c, bits: [int.from_bytes(S._fold(np.frombuffer(x, np.uint8)[None], bits).tobytes(), "big") if x else None for x in table.column(c).to_pylist()]
    bag, twos = of("bag", bits), of("twos", bits * S.TWOS)
    out = set()
    for i in range(n):
        for j in range(i):
            limit, apart = int(S.MAX_SHARE * max(about[0, i], about[0, j]) + 1e-9), abs(about[0, i] - about[0, j])
            if np.abs(about[:, i] - about[:, j]).max() <= limit and (bag[i] ^ bag[j]).bit_count() <= 2 * limit - apart:
                if twos[i] is None or twos[j] is None or (twos[i] ^ twos[j]).bit_count() <= 4 * limit - apart:
                    out.add((j, i))
    return out


def test_tiles_leave_what_whole_bags_leave(monkeypatch):
    """Chinese and Latin texts and such between, in tiles of few texts, so that all kinds meet."""
    monkeypatch.setattr(S, "TILE", 16)
    rng = random.Random(5)
    phrases = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(4, 12))) for _ in range(12)]
    texts = []
    for _ in range(60):
        n = rng.randrange(90, 130)
        han, latin = sentence(rng, n), "".join(rng.choice(phrases) for _ in range(n))[: n + 20]
        for base in (han, latin, han[: n * 2 // 3] + latin[: n // 3]):
            texts += [base, edited(rng, base, rng.randrange(0, len(base) // 8))]
    table = block(texts)
    ids = table.column("id").to_pylist()
    want = {tuple(sorted((ids[i], ids[j]))) for i, j in left(table)}
    got = [tuple(sorted(p)) for a, b, _ in S._block(table, S.MAX_SHARE) for p in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_short_texts_multiply_few_bits(monkeypatch):
    """Half of the bits tell texts of some 100 characters apart; all were multiplied before."""
    work = [0, 0]

    def matmul(x, y, f=np.matmul, **k):
        work[0] += x.shape[0] * y.shape[1] * x.shape[1]
        work[1] += x.shape[0] * y.shape[1]
        return f(x, y, **k)

    rng = random.Random(6)
    table = block(["".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(100 + i % 8)) for i in range(1500)])
    monkeypatch.setattr(np, "matmul", matmul)
    assert list(S._block(table, S.MAX_SHARE)) == [] and work[1] > 0 and work[0] <= work[1] * S.BAG_BITS / 2
