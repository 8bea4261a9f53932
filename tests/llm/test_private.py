"""Personal data against the plain patterns, and the terms that reveal it."""

import random
import re
from hashlib import sha256

from stationflow.llm import privacy

KINDS = ("email", "ip", "card", "phone")


def luhn(digits):
    return sum((2 * d - 9 if d > 4 else 2 * d) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_base_spans(spark):
    rng = random.Random(5)
    parts = ["a", "b", "1", "2", "4", "0", "9", ".", "@", "+", "-", " ", "(", ")", "é", "😀", "4111 1111 1111 1111", "192.168.0.1",
             "x@y.zz", "+1 (555) 123-4567", "\n", "_", "256.1.1.1", "4111-1111-1111-1111", "1.2.3.4.5.6.7.8"]
    texts = {k: "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for k in range(400)}
    texts |= {400: "x@" + "a." * 9000 + "b", 401: "1 " * 20000, 402: "9" * 40000, 403: "a" * 60000 + "@", 404: "a@b.com+x@y.zz", 405: "1." * 1200}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for r in privacy.counted(rows).collect():
        want = plain(texts[r.doc_id])
        written = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in want) for k in range(4)]
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))


def test_terms_that_reveal_an_entity(spark):
    rows = [(k, f"plain words about zanzibar write to me@site.org today plain words {k}") for k in range(3)]
    rows += [(k, f"plain words about other things written today number {k}") for k in range(3, 60)]
    out = {r.doc_id: r for r in privacy.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "zanzibar" not in out[0].text and "me@site.org" not in out[0].text and "<EMAIL>" in out[0].text
    assert "plain words about" in out[0].text and out[30].text == rows[30][1]
