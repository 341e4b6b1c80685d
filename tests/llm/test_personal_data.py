import re
from hashlib import sha256

import numpy as np
import pytest

from frostline.llm import personal_data as pd

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, span):
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(PATTERNS[k], text or "") if valid(k, m.group())]


TEXTS = [
    "", "a@b.c a@b a@@b.co x.y+z@m-1.example.com.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 1.2.3 01.002.0003.4", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "+1 (017) 555-7713 +49 30 1234567 ++1 2 +12345678 (030) 123-4567", "a@b.c@d.e f@g.h.i@j.k", "79927398713 5500005555555559 é 5500005555555559", None,
    "mail joe [at] example [dot] com or call 030 1234 5678", "+1 555 555 5555+1 444 444 4444", "@a.b .@a.b a@-.-",
]


@pytest.mark.parametrize("text", TEXTS)
def test_proven_spans(text):
    base, loose = pd.found_spans(text or "")
    assert [(KINDS[k], a, b) for k, a, b in sorted(base)] == brute(text)
    assert all(b <= x or y <= a for _, a, b in loose for _, x, y in base)


def test_whole_tables_equal_plain_patterns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = {r["doc_id"]: r for r in pd.personal_data(docs).collect()}
    for r in docs.collect():
        spans = brute(r["text"])
        got = out.pop(r["doc_id"])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [got[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert got["base_sha256"] == sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got["spans"].split(","))
    assert not out


def test_added_spans_and_clean_texts(spark):
    rows = [(i, f"please mail jane.doe{i} [at] example [dot] com today") for i in range(30)]
    rows += [(100 + i, f"write to ann{i}@example.org or phone +1 (212) 555-{1000 + i}") for i in range(60)]
    rows += [(200 + i, f"order no {1000000000000000 + 7919 * i} of version 300.400.1.{i}") for i in range(60)]
    rows += [(300, None), (301, ""), (302, "no data here at all"), (303, "x" * 300_000 + " 9" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in pd.personal_data(docs).collect()}
    assert len(out) == len(rows)
    assert all(out[i].startswith("email:12:") for i in range(30))
    assert all(out[200 + i] == "" for i in range(60) if not brute(rows[90 + i][1]))
    assert out[300] == out[301] == out[302] == ""


def test_reliable_labelers_are_found():
    draw = np.random.default_rng(5)
    truth = draw.random(4000) < 0.4
    right = (0.95, 0.9, 0.8, 0.7, 0.9, 0.6)
    codes = []
    for t in truth:
        cast = tuple(pd.FOR if (draw.random() < p) == t else pd.AGAINST for p in right)
        code = 1
        for v in (*cast, 0, 0):
            code = 3 * code + v
        codes.append(code)
    unique, counts = np.unique(codes, return_counts=True)
    posterior, table = pd.reliabilities(unique, counts.astype(float))
    for j, p in enumerate(right):
        assert abs(table[1, j, 1, pd.FOR] - p) < 0.06
    guess = dict(zip(unique.tolist(), posterior > 0.5))
    assert np.mean([guess[c] == t for c, t in zip(codes, truth)]) > 0.95


def test_empty_table(spark):
    assert pd.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
