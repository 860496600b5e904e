import hashlib
import random
import re
from collections import Counter

from salescube.llm import pii
from tests.llm.samples import frame

TEXTS = [
    "mail a.b@c.de, x@y.z.w. and @nope @@a@b.c", "ü 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 256.1.1.1", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 123-4567 or +12", None, "",
    "日本 me@site.org+49 30 1234567 x", "a@b.c@d.e", "1234567890123456789012345", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "00000000255.1.2.3", "x." * 50 + "@a.b", "4111111111111111.", "...@...",
]


def _luhn(s):
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(int(c) for c in reversed(s))) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    s = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    s += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    s += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0]))]
    s += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    n = Counter(k for _, k, _ in s)
    listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(s))
    return n[0], n[1], n[2], n[3], 0, hashlib.sha256(listed.encode()).hexdigest(), listed


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (2, TEXTS[2])]
    got = pii.scan(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_random_texts():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("a1 .@+-()42%é") for _ in range(rng.randrange(40)))
        assert ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text)) == brute(text)[6], text


def test_real_texts(spark):
    path = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    for r in pii.op10_pii(spark, path).collect():
        assert tuple(r)[1:] == brute(text[r.doc_id])


def _contexts():
    rows = [(i, f"some filler text then reach me under user{i}@mail.org today") for i in range(8)]
    rows += [(20 + i, f"other filler words, reach me under handle-{1000 + i}, please") for i in range(3)]
    rows += [(30 + i, f"please order part {5000 + i} now") for i in range(8)]
    return rows


def test_confident_patterns_find_unseen_identifiers(spark):
    found = {r.doc_id: r for r in pii.scan(frame(spark, _contexts())).collect()}
    for i in range(3):
        text = dict(_contexts())[20 + i]
        begin = text.index("handle-")
        assert found[20 + i].spans == f"context:{begin}:{begin + 11}" and found[20 + i].n_context == 1
    assert all(found[30 + i].spans == "" for i in range(8))


def test_redaction_and_empty(spark):
    rows = [*_contexts(), (99, None), (98, "")]
    documents = frame(spark, rows)
    out = pii.redacted(documents)
    assert out.schema == documents.schema
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[0] == "some filler text then reach me under <email> today" and text[21] == "other filler words, reach me under <context>, please"
    assert text[30] == dict(rows)[30] and text[99] is None and text[98] == ""
    assert pii.scan(frame(spark, [])).count() == 0


#: What stands before and after an identifier; the first two come with addresses, the last with numbers that identify nobody.
FRAMES = ["reach me under", "my account is", "order part number"]


def test_unseen_identifiers_planted_into_real_texts(spark):
    """In texts of sf0.01: 60 addresses after each of two phrases, then 100 handles and badge numbers that no base pattern describes."""
    rng = random.Random(17)
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").orderBy("doc_id").select("doc_id", "text")
    rows, unseen = [tuple(r) for r in documents.collect()], {}
    for i in range(320):
        doc_id, text = rows[i]
        at = text.find(" ") + 1
        number = rng.randrange(10_000, 100_000)
        phrase = FRAMES[i % 2] if i < 220 else FRAMES[2]
        held = f"user{number}@mail{i}.org" if i < 120 else f"{rng.choice(['handle', 'badge'])}-{number}" if i < 220 else str(number)
        rows[i] = (doc_id, f"{text[:at]}{phrase} {held} {text[at:]}")
        if 120 <= i < 220:
            begin = at + len(phrase) + 1
            unseen[doc_id] = f"context:{begin}:{begin + len(held)}"
    hits = calls = 0
    for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect():
        calls += r.n_context
        hits += unseen.get(r.doc_id) in r.spans.split(",")
    assert hits >= 90 and hits >= 0.95 * calls, (hits, calls)
