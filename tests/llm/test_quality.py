"""Quality rules against a brute-force version with the same hashes."""

import collections
import math
import re

import numpy as np
import xxhash

from quarry.llm import quality

SCHEMA = "doc_id long, text string, n_words int, place int, ratio string, kept string, target int"


def base(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return words, (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def places(words):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    eight = lambda x: x.to_bytes(8, "little")
    h += [xxhash.xxh64_intdigest(eight(b), xxhash.xxh64_intdigest(eight(a), 42)) for a, b in zip(h, h[1:])]
    return [signed(x) % quality.PLACES for x in h]


def brute(rows, trusted):
    grams = [places(base(t)[0]) for _, t in rows]
    raw, target = collections.Counter(), collections.Counter()
    for (d, _), g in zip(rows, grams):
        raw.update(g)
        if d in trusted:
            target.update(g)
    r, t = sum(raw.values()), sum(target.values())
    p = quality.PRIOR
    out = []
    for (d, text), g in zip(rows, grams):
        ratio = sum(math.log((target[x] + p * raw[x] / r) / (t + p)) - math.log(raw[x] / r) for x in g) / max(1, len(g)) if t else 0.0
        b = base(text)[1]
        out.append((d, *b, not b[-1] and ratio >= quality.LEAST, ratio))
    return out


def judged(spark, rows, trusted):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y", 3) for r in rows], SCHEMA).repartition(3)
    ids = spark.createDataFrame([(d,) for d in trusted], "doc_id long")
    got = quality.judge_quality(df, ids)
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio").collect()


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:-1])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:-1]) for r in got] == [r[:-1] for r in want]
    assert np.allclose([r[-1] for r in got], [r[-1] for r in want], atol=1e-9)


def corpus():
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefgé"), 4)) for _ in range(20)]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    rows = [(i, prose(int(rng.integers(5, 90)))) for i in range(60)]
    rows += [(100 + i, " ".join(w + "%%%" for w in prose(60).split())) for i in range(6)]  # junk
    passage = prose(8)
    rows += [
        (200, None), (201, ""), (202, " \t\n\x0b\x0c\r "), (203, "one"), (204, prose(7)), (205, passage + " " + passage), (206, "la " * 40),
        (207, prose(40) + " " + passage + " x " + passage + " " + prose(40)), (208, (prose(5) + "\n") * 2 + "\n \n\t\n" + "a\r\na\r\na\n"),
        (209, "😀 <a>|b& " * 5 + prose(30)), (210, prose(20000)), (None, prose(50)), (None, prose(30)), (5, prose(40)), (211, "  nbsp is a word"),
    ]
    return rows + rows[:7]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "PLACES", 1 << 12)
    monkeypatch.setattr(quality, "PRIOR", 100)
    rows, trusted = corpus(), {*range(0, 50, 2), 5, 999}
    got = judged(spark, rows, [*trusted, *trusted, None])
    same(got, brute(rows, trusted))
    assert all(not r.kept for r in got if r.doc_id in range(100, 106))
    assert sum(r.kept for r in got) > 40


def test_without_trusted_or_rows(spark):
    rows = corpus()
    same(judged(spark, rows, []), brute(rows, set()))
    same(judged(spark, rows, [200, 777]), brute(rows, {200}))  # trusted, but without a word
    assert judged(spark, [], [1]) == []


def test_many_repeats_in_one_text(spark):
    """A text of many equal windows is worked on in one sort."""
    text = " ".join(f"w{i % 1000}" for i in range(120_000))
    (r,) = judged(spark, [(1, text)], [])
    assert (r.n_words, r.n_repeat_words, r.base_failed) == (120_000, 120_000, True)
