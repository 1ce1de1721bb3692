import math

import pytest

from chirpscope.llm import license_scan as S

from .conftest import docs_frame


def brute(rows, templates=S.TEMPLATES):
    grams = lambda w: [tuple(w[i:i + S.SHINGLE]) for i in range(len(w) - S.SHINGLE + 1)]
    out = []
    for doc_id, text in rows:
        w, found = S.template_words(text or ""), {}
        for name, t in templates:
            tw = S.template_words(t)
            goal, width, stride = set(grams(tw)), S.width_of(len(tw)), S.stride_of(len(tw))
            best = max((len(goal & set(grams(w[s:s + width]))) / len(goal) for s in range(0, max(1, len(w)), stride)), default=0)
            if best >= S.CONTAINED:
                found[name] = best
        out.append((doc_id, len(found), ",".join(sorted(found)), round(max(found.values(), default=0.0), 6)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(odd_rows):
    out = [(r[0], r[1]) for r in odd_rows]
    for i, (_, t) in enumerate(S.TEMPLATES):
        w = t.split()
        out += [(100 + i, f"some words before. {t} And after."), (200 + i, t.upper()), (300 + i, " ".join(w[:len(w) // 2])),
                (400 + i, " ".join([*w[:-1], "changed"])), (500 + i, f"{t}\n{S.TEMPLATES[i - 1][1]} x {t}")]
    return out


def test_matches_all_windows(spark, rows):
    got = S.license_table(docs_frame(spark, [(d, t, "en", "s") for d, t in rows]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_bands_reach_their_guarantee():
    lengths = sorted({len(S.template_words(t)) for _, t in S.TEMPLATES})
    bands = S.bands_for(lengths)
    for n in lengths:
        inter, whole, window = S.needed(n), n - S.SHINGLE + 1, S.width_of(n) - S.SHINGLE + 1
        same = inter / (window + whole - inter)
        assert same >= 1 or (1 - same ** S.ROWS) ** bands <= S.MISS * 1.001 and math.isfinite(bands)


def test_empty_and_short_templates(spark, nothing):
    assert S.license_table(nothing).collect() == []
    with pytest.raises(ValueError):
        S.license_table(nothing, templates=[("x", "two words")])
