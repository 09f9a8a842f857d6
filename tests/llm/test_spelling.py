"""Spelling variants against a brute-force version."""

import collections
import re
import zlib

import numpy as np
import pytest

from quarry.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, code long, red string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(rows):
    counts = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, spelling.spelling_variants(df).collect()))


def texts(seed):
    """Random words with typing errors; very frequent ones, chains of forms, ties."""
    rng = np.random.default_rng(seed)
    letters = list("abcdeéß×ÿ")
    words = ["".join(rng.choice(letters, rng.integers(6, 10))) for _ in range(60)]
    out = []
    for i in range(250):
        some = list(rng.choice(words, 30, p=np.r_[0.4, np.full(59, 0.6 / 59)]))
        for j in range(0, 30, 4):
            w, k = some[j], int(rng.integers(0, len(some[j])))
            some[j] = [w[:k] + w[k + 1 :], w[:k] + "a" + w[k:], w[:k] + "b" + w[k + 1 :], w.capitalize()][int(rng.integers(0, 4))]
        out.append((i, " ".join(some)))
    return out


def test_equals_brute_force(spark):
    rows = texts(3)
    # A chain of three forms, ties of two forms, a word of one repeated letter.
    rows += [(300 + i, "chainword " * 30 + "chainwor " * (6 if i % 5 == 0 else 0) + ("chainwo " * 5 if i == 1 else "")) for i in range(30)]
    rows += [(400, "tiewordx " * 50 + "tiewordy " * 50 + "tieword " * 7 + "aaaaaaa " * 9 + "aaaaaa " * 60)]
    rows += [(None, "nullword " * 40), (None, "Nullword " * 5 + "nullwort " * 6), (401, None), (402, ""), (403, "... 123 short"), (404, "ZÉBRULON zÉbrulon zébrulon " * 6), (405, "longword" * 3000 + " "), (405, "longword" * 3000 + " ")]
    rows += [(406 + i, ("verylong" * 500 + "x ") * (1 + i) + ("verylong" * 500 + " ") * 30) for i in range(3)]
    rows += rows[:40]  # repeated rows count as they stand
    got = found(spark, rows)
    assert got == brute(rows)
    assert any(r[1] and r[2] != r[1] for r in got)
    assert sum(r[1] is not None for r in got) > 20


def test_empty(spark):
    assert found(spark, []) == found(spark, [(1, None), (2, "few words here")]) == []


def test_planted_errors_find_their_word(spark):
    """Words that lost a letter by the rule lead back to the whole word."""
    rows = [(i, "reconstruction") for i in range(30000)]
    got = {r[0]: r for r in found(spark, rows)}
    whole = got.pop("reconstruction")
    assert whole[1] is None and whole[4] == len(got) > 0
    assert all(r[1] == r[2] == "reconstruction" and r[5] == whole[3] for r in got.values())


@pytest.mark.parametrize("red", ["000000", "01234567", "7065040312", "0"])
def test_neighbourhood_is_the_whole_one(red):
    digits = "".join(map(str, range(spelling.SYMBOLS)))
    want = {red} | {red[:i] + red[i + 1 :] for i in range(len(red))}
    want |= {red[:i] + c + red[i + 1 :] for i in range(len(red)) for c in digits} | {red[:i] + c + red[i:] for i in range(len(red) + 1) for c in digits}
    code = lambda r: int(spelling.codes_of(spelling._symbols([r]))[0]) if r else 0
    row, got = spelling.neighbourhoods(spelling._symbols([red, red[::-1]]))
    assert sorted(got[row == 0].tolist()) == sorted({code(w) for w in want})
    assert len({code(w) for w in want}) == len(want)
