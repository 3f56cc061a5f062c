"""Operators made of SQL functions alone: duplicates, shards, personal data, leaks."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from strandline.llm import pii
from strandline.llm.decontamination import find_leaks
from strandline.llm.exact_dedup import find_duplicates
from strandline.llm.sharding import grid, shard
from tests.llm.samples import AWKWARD, edited, prose, table


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_duplicates_by_brute_force(spark):
    rng = random.Random(1)
    rows = AWKWARD + [(i, prose(rng, 3, 4)) for i in range(20, 120)] + [(i, "hot  copy" if i % 2 else "hot copy") for i in range(200, 300)]
    rows += [(400, "x" * 300_000), (401, "x" * 299_999 + " x")]
    got = find_duplicates(table(spark, rows).repartition(24)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[strip(t)].append((-len(t or ""), i is None, i or 0))
    expected = Counter()
    for body, members in groups.items():
        first = min(members)
        for m in members:
            expected[(None if m[1] else m[2], None if first[1] else first[2], len(members), hashlib.sha256(body.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(hashlib.sha256(b.encode()).hexdigest() for b in groups)


def test_exact_duplicates_of_nothing(spark):
    assert find_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 41, 1000])
def test_shards_are_even_and_reproducible(spark, n):
    rows = (AWKWARD + [(i, f"text {i % 7}") for i in range(10, 1000)])[:n]
    got = shard(table(spark, rows), shards=40).collect()
    again = shard(table(spark, rows[::-1]).repartition(7), shards=40).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == n and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected


def plain_hash(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed)
    return seed - (seed >> 63 << 64)


def plain_place(number, rows, seed):
    a, b = grid(rows)
    while True:
        left, right = divmod(number, b)
        for r in range(6):
            key = seed * 6 + r
            if r % 2 == 0:
                left = (left + plain_hash(right, key) % a) % a
            else:
                right = (right + plain_hash(left, key) % b) % b
        number = left * b + right
        if number < rows:
            return number


@pytest.mark.parametrize("n", [1, 2, 7, 990])
def test_places_are_those_of_a_plain_permutation(spark, n):
    rows = [(None, "x"), *((i * 37 % 1009, f"text {i % 7}") for i in range(n - 1))]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    wanted = {}
    for number, (i, _) in enumerate(order):
        p = plain_place(number, n, 20_240_601)
        wanted[i] = (p % 40, p // 40)
    assert len(set(wanted.values())) == n
    assert {r.doc_id: (r.shard, r.slot) for r in shard(table(spark, rows), shards=40).collect()} == wanted


def test_shuffle_does_not_keep_neighbours_together(spark):
    got = {r.doc_id: r.shard for r in shard(table(spark, [(i, "t") for i in range(2000)]), shards=10).collect()}
    same = sum(got[i] == got[i + 1] for i in range(1999))
    assert 130 < same < 280  # a tenth of 1999, give or take five deviations


def test_grid_holds_all_numbers_and_little_more():
    for n in [*range(1, 200), 10**6, 10**12 + 7]:
        a, b = grid(n)
        assert n <= a * b < n + a


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(pii.PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                marks = [int(c) for c in digits[::-1]]
                total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(marks))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(out)]


PERSONAL = [
    "mail a.b+c@x-y.co.uk, then d@e.fg.@h.ij and k@l, m@n.o@p.q.r 7@8.9",
    "é😀 4111 1111 1111 1111 and 4111-1111-1111-1112 or 5500005555555559 0 00 000",
    "1.2.3.4.5.6.7.8 and 999.1.1.1 and 010.020.030.255, 1.2.3 0256.1.1.1 300.1.2.3.4",
    "+1 (017) 555-7713 +44 20 7946 0958. +12 3 +1234567890123456 ++49-30-123456 +1+2 345 678 901",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not GB82WEST12345698765431",
    "my ssn 123-45-6789, order 123-45-6789-0 then 123-45-6789 again; call 555 123 4567 or just 555 123 4567 " + "x" * 60 + " 555 123 4567",
    "1" * 30_000 + " " + "a" * 30_000 + "@" + "b." * 3000 + "c " + "1." * 5000 + "1 " + "+1 " * 3000,
    "", None, "nothing here",
]


def test_personal_data_by_brute_force(spark):
    rng = random.Random(2)
    rows = list(enumerate(PERSONAL)) + [
        (100 + i, "".join(rng.choice("01289.@+- ()ab\n") for _ in range(rng.randrange(80)))) for i in range(400)
    ]
    found = pii.find_pii(table(spark, rows))
    for row, (i, text) in zip(sorted(found.collect(), key=lambda r: r.doc_id), sorted(rows)):
        expected = plain_spans(text or "")
        assert [(s.kind, s.start, s.end) for s in row.base] == expected, (i, text)
        assert set(expected) <= {(s.kind, s.start, s.end) for s in row.spans}
        assert all((text or "")[s.start : s.end] == s.value for s in row.spans)
    digested = {r.doc_id: r for r in pii.digest(found).collect()}
    for i, text in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert digested[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert digested[i].n_ip == sum(k == "ip" for k, _, _ in spans)


def test_personal_data_of_the_method(spark):
    found = {r.doc_id: [(s.kind, s.value) for s in r.spans] for r in pii.find_pii(table(spark, list(enumerate(PERSONAL)))).collect()}
    assert [v for k, v in found[4] if k == "iban"] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    # The words that support a number stand before it, at most 40 characters away.
    assert [k for k, _ in found[5]].count("ssn") == 1 and [k for k, _ in found[5]].count("local_phone") == 2


def test_words_behind_a_number_support_it(spark):
    texts = ["123-45-6789 (SSN)", "555 123 4567 tel.", "123-45-6789 " + "x" * 40 + " ssn", "123-45-6789 classn", "555 123 4567"]
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(table(spark, list(enumerate(texts)))).collect()}
    assert found == {0: ["ssn"], 1: ["local_phone"], 2: [], 3: [], 4: []}


def test_many_spans_in_one_text(spark):
    """Time in proportion to the text: 100,000 addresses, and as many numbers among which some are base spans."""
    mails = " ".join(f"u{i}@ex.org" for i in range(100_000))
    numbers = " ".join(f"ssn 123-45-{i:04}" if i % 2 else f"a{i}@b.cc 10.0.{i % 256}.1" for i in range(1, 10_000))
    docs = table(spark, [(1, mails), (2, numbers)]).repartition(2).cache()
    docs.count()
    start = time.perf_counter()
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(docs)).collect()}
    assert time.perf_counter() - start < 30
    assert got[1].n_email == 100_000 and got[1].spans.endswith(f"email:{len(mails) - 13}:{len(mails)}")
    assert (got[2].n_email, got[2].n_ip, got[2].spans.count("ssn:")) == (4999, 4999, 5000)
    docs.unpersist()


def test_context_reaches_over_other_spans(spark):
    texts = ["tel 1: 555 123 4567, 555 123 4568", "12,34,56,78 ssn 12,34,56 123-45-6789", "555 123 4567 / 555 123 4568 / phone", "phone " + "12," * 12 + " 555 123 4567"]
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(table(spark, list(enumerate(texts)))).collect()}
    assert found == {0: ["local_phone"] * 2, 1: ["ssn"], 2: ["local_phone"] * 2, 3: []}


def test_redaction(spark):
    rows = pii.redact(pii.find_pii(table(spark, [(1, "to é@x.yz a@b.cd!"), (2, None), (3, "no")]))).collect()
    assert {r.doc_id: r.clean_text for r in rows} == {1: "to é@x.yz [email]!", 2: "", 3: "no"}


def test_personal_data_of_nothing_and_awkward_rows(spark):
    assert pii.digest(pii.find_pii(table(spark, []))).count() == 0
    assert pii.find_pii(table(spark, AWKWARD)).count() == len(AWKWARD)


def word_shingles(text):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def held_shingles(text, item):
    """A document's runs of five words, or of as many as a shorter item has."""
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if x]
    n = min(5, max(map(len, item), default=5))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_short_items_are_found_inside_long_documents(spark):
    rng = random.Random(5)
    items = [(1, "zulu"), (2, "Yankee Zulu"), (3, "x-ray, yankee zulu!"), (4, "whiskey x ray yankee"), (5, "a b c d e"), (6, "zulu zulu")]
    rows = AWKWARD + [(100, prose(rng, 30_000) + " whiskey x ray yankee zulu " + prose(rng, 500)), (101, "yankee zulu"), (102, "ZULU"), (103, "zu lu")]
    got = find_leaks(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(100, 1), (100, 2), (100, 3), (100, 4), (101, 1), (101, 2), (102, 1)}


def test_leaks_by_brute_force(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randrange(1, 70), 3000)) for i in range(40)] + [(40, None), (41, ""), (42, "one two three four five six"), (0, "again")]
    rows = list(AWKWARD)
    for i in range(120):
        text = prose(rng, rng.randrange(400))
        item = items[rng.randrange(40)][1]
        rows.append((100 + i, text + ". " + edited(rng, item, rng.randrange(3)).upper() + "\n" + prose(rng, 20)))
    rows += [(900, items[3][1]), (900, items[3][1]), (901, prose(rng, 60_000) + " " + items[5][1])]
    got = find_leaks(table(spark, rows), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS hash")).collect()
    expected = set()
    for d, t in rows:
        held = word_shingles(t)
        for i, x in items:
            q = word_shingles(x)
            held = held_shingles(t, q)
            if q and 100 * len(q & held) >= 80 * len(q):
                expected.add((d, i, len(q), len(q & held)))
    assert Counter((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in got) == Counter(expected)
    assert len(expected) > 60


def test_leaks_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert find_leaks(table(spark, AWKWARD), none).count() == 0
    assert find_leaks(table(spark, []), some).count() == 0
