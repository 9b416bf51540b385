"""Blocks of pairs: each text is written once, and beginnings rule out no near pair."""

import random

import numpy as np
import pyarrow as pa

from sparkloom.llm import segments as S
from tests.llm.test_history_and_splits import edited, sentence


def test_each_text_is_written_once(spark, monkeypatch):
    """However many blocks it is in; each block got a copy of it before."""
    monkeypatch.setattr(S, "BLOCK", 20)
    rng = random.Random(31)
    texts = [sentence(rng, rng.randrange(70, 90)) for _ in range(150)]
    texts += [edited(rng, t, 3) for t in texts[:10]]
    written = []

    def parts(df, name, by, f=S.materialize_parts):
        written.extend(f(df, name, by))
        return written

    monkeypatch.setattr(S, "materialize_parts", parts)
    rows = spark.createDataFrame(list(enumerate(texts)), "record_id bigint, text string")
    got = S.every_candidate(S.sketches(rows, ["record_id"]).withColumnsRenamed({"record_id": "id"}).selectExpr("*", "id AS ask", "id AS answer")).collect()
    assert {(i, 150 + i) for i in range(10)} <= {tuple(sorted((r.a, r.b))) for r in got}
    assert len(written) > 5 and sum(S._read([p], ["id"], 0).num_rows for p in written) == len(texts)


def test_beginnings_of_many_rule_out_no_near_pair(monkeypatch):
    """Texts of the same phrases in another order are ruled out, near ones of several lengths and edits are not."""
    monkeypatch.setattr(S, "AT_LEAST", 1)
    rng = random.Random(32)
    phrases = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(10, 30))) for _ in range(40)]
    texts, pairs = [], []
    for n in (8, 15, 30, 60):
        for _ in range(25):
            one = "".join(rng.choice(phrases) for _ in range(n))
            t = list(one)
            for _ in range(rng.randrange(0, int(0.12 * len(t)))):
                i = rng.randrange(len(t) if rng.random() < 0.5 else len(t) // 5)
                t[i : i + rng.choice([0, 1, 1])] = rng.choice(["", "x", "yz"])
            texts += [one, "".join(t), "".join(rng.choice(phrases) for _ in range(n))]
            pairs += [(len(texts) - 3, len(texts) - 2), (len(texts) - 2, len(texts) - 3), (len(texts) - 3, len(texts) - 1)]
    _, codes, lengths = S._kept(texts, 1)
    heads = S._flat(pa.chunked_array([S._heads(codes, lengths, np.ones(len(lengths), bool))]))
    p, q = np.array(pairs).T
    may = S._begin_alike(heads, lengths.astype(np.int64), p, q, S.MAX_SHARE)
    near = np.array([S.within(texts[a], texts[b], int(S.MAX_SHARE * max(len(texts[a]), len(texts[b])) + 1e-9)) is not None for a, b in pairs])
    assert near.sum() > 100 and may[near].all() and may[2::3].sum() < 30


def test_products_of_rows_in_one_are_told_apart():
    rng = np.random.default_rng(33)
    for bits in (64, 96, 128, 192, 1024):
        x, y = (rng.integers(0, 2, (n, bits)).astype(np.float32) * 2 - 1 for n in (18, 40))
        x[:6], y[:2] = y[0], y[0]
        rows = S._rows(bits)
        one = sum(x[r::rows] * np.float32(S._apart(bits) ** r) for r in range(rows))
        space = np.empty(len(one) * len(y), np.float32), np.empty(len(one) * len(y), bool)
        for least in (-bits, -3, 2, bits // 4, bits):
            want = {tuple(z) for z in np.argwhere(x @ y.T >= least).tolist()}
            got = set()
            for k, flat in enumerate(S._above((one @ y.T).reshape(-1), bits, rows, least, space)):
                got |= {(int(f // len(y)) * rows + rows - 1 - k, int(f % len(y))) for f in flat}
            assert got == want, (bits, least)
