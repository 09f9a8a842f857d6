"""Substring dedup: rows of null and repeated ids are told apart by their texts."""

import collections
import re

import numpy as np
import pyarrow as pa

from quarry.llm import substring

RNG = np.random.default_rng(8)


def prose(n):
    return " ".join(f"w{x}" for x in RNG.integers(0, 10**9, n))


def brute(rows, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, name int, tag string, place int")
    return sorted(map(tuple, substring.remove_repeats(df.repartition(3)).collect()), key=str)


def same_tag():
    """Two texts of 60 words whose tags agree."""
    tags = {}
    while True:
        t = prose(60)
        tag = int(substring._names(pa.array([None], pa.int64()), [t])[1][0])
        if tag in tags:
            return tags[tag], t
        tags[tag] = t


def test_unique_text_under_null_ids_stays(spark):
    a, b = same_tag()
    for one, two in ((None, None), (7, 7)):
        rows = [(one, a), (two, b), (1, f"x {a} y")]
        assert found(spark, rows) == brute(rows)
        assert (two, 60, 0, b) in found(spark, rows)


def test_names_hold_id_and_text():
    texts = [prose(5) for _ in range(50)]
    ids = pa.array([None, 0, 1, -1, 2**63 - 1] * 50, pa.int64())
    names, _ = substring._names(ids, [t for t in texts for _ in range(5)])
    assert len(set(names.tolist())) == 250
    again, _ = substring._names(ids[:5], texts[:1] * 5)
    assert again.tolist() == names[:5].tolist()


def test_many_rows_of_one_null_id_text(spark):
    t, part = prose(80), prose(50)
    rows = [(None, t)] * 60 + [(None, prose(70)) for _ in range(60)] + [(None, None), (None, ""), (3, f"{part} a {part}"), (3, f"b {part}"), (3, t[: t.rindex(" ")])]
    assert found(spark, rows) == brute(rows)


def test_windows_with_long_symbols_skip_the_words(monkeypatch):
    asked, best = [], substring._best
    monkeypatch.setattr(substring, "_best", lambda level, at, n: asked.append(len(at)) or best(level, at, n))
    p = substring.Parsed([prose(400)])
    full = np.maximum.reduce([best(x, p.at, 400) for x in levels(p)])
    assert p.key.tolist() == full.tolist() and sum(asked) < 4 * len(p.at)


def levels(p):
    h = substring._HASHES.of(p.words[0])
    place = np.arange(len(h))
    out = [substring.Symbols(h, place, place + 1, place, place + 1, np.zeros(len(h), np.int64))]
    for k in range(1, substring.LEVELS + 1):
        out.append(out[-1].runs(k).pairs(k))
    return out
