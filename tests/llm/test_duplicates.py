"""Exact, near and passage duplicates, and leaks, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontaminate, simhash, substring, verified
from tessera.llm.decontaminate import leaks
from tessera.llm.exact import exact_groups
from tessera.llm.simhash import Ring, simhash_groups, similar_groups
from tessera.llm.substring import remove_repeats

from .conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


@pytest.mark.parametrize("hash_bytes", [16, 1])
def test_exact_groups(spark, odd, hash_bytes):
    """One byte of hash makes many texts collide, so their bytes decide."""
    rows, docs = odd
    own = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[own(t)].append(i)
    want = Counter((i, least(groups[own(t)]), len(groups[own(t)]), hashlib.sha256(own(t).encode()).hexdigest()) for i, t in rows)
    got = exact_groups(docs, hash_bytes=hash_bytes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def removed(rows, width):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, np.inf), np.inf if i is None else i)
    found = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (np.inf if i is None else i):
                gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        found.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return found


@pytest.mark.parametrize("width", [13, 20])
def test_repeated_passages(spark, odd, monkeypatch, width):
    rows, docs = odd
    monkeypatch.setattr(substring, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 50_000)
    got = remove_repeats(docs, width=width, keep=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == Counter(removed(rows, width))


def test_cover_meets_every_shift():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any((i + d) % substring.PERIOD in substring.COVER and (j + d) % substring.PERIOD in substring.COVER for d in range(substring.PERIOD))


def fingerprint(text, shingle=3):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(values, radius):
    values = sorted(set(values))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_simhash_groups(spark, odd):
    rows, docs = odd
    prints = [fingerprint(t) for _, t in rows]
    root = joined(prints, 3)
    groups = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        groups[root[p]].append(i)
    want = Counter((i, f"{p:016x}", least(groups[root[p]])) for (i, _), p in zip(rows, prints))
    assert Counter(tuple(r) for r in simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()) == want


@pytest.mark.parametrize("radius,segments,chain", [(3, 4, 2), (5, 8, 3), (2, 4, 3), (0, 2, 2), (7, 8, 2)])
@pytest.mark.parametrize("tile", [4096, 8])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, radius, segments, chain, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(radius)
    values = [0, 2**64 - 1, 2**63]
    for _ in range(12):
        own = rng.getrandbits(64)
        values.append(own)
        for _ in range(25):
            values.append(rng.choice(values[-3:]) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, radius + 2))) & (2**64 - 1))
    values = sorted(set(v & (2**64 - 1) for v in values))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), radius, segments, chain).collect()
    near = [(r.src & (2**64 - 1), r.dst & (2**64 - 1)) for r in got]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in near)
    root = joined(values, radius)
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in near:
        parent[find(a)] = find(b)
    assert len({find(v) for v in values}) == len(set(root.values()))
    assert all(root[a] == root[b] for a, b in near)


def test_ring_needs_room():
    for bad in ((4, 4, 2), (3, 5, 2), (3, 4, 5)):
        with pytest.raises(ValueError):
            Ring(*bad)


def test_similar_groups_hold_by_shingles(spark, odd):
    rows, docs = odd
    found = {(r.doc_id, r.component_id) for r in similar_groups(docs).collect()}
    by = dict(found)
    assert Counter(r.doc_id for r in similar_groups(docs).collect()) == Counter(i for i, _ in rows)
    # Copies, white space and case aside.
    assert by[8] == by[9] == 8 and by[60] == by[59] and by[1] == by[2] == by[3] == 1 and by[13] == 13 and by[None] is None
    rng = random.Random(9)
    text = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near = text[:200] + ["changed"] + text[201:]
    far = text[:40] + [f"v{rng.randrange(10**6)}" for _ in range(360)]
    pair = {r.doc_id: r.component_id for r in similar_groups(frame(spark, [(5, " ".join(near)), (3, " ".join(text)), (9, " ".join(far))])).collect()}
    assert pair == {3: 3, 5: 3, 9: 9}


def shingles(text, width=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def grouped(rows):
    """The smallest id that links of all pairs reach, by brute force."""
    sets = [shingles(t) for _, t in rows]
    part = {i: i for i, _ in rows}
    for a, (i, _) in enumerate(rows):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and part[i] != part[rows[b][0]]:
                old, new = sorted((part[i], part[rows[b][0]]), reverse=True)
                part = {k: new if v == old else v for k, v in part.items()}
    return part


def edited(rng, text, share):
    own = list(text)
    for k in rng.sample(range(len(own)), int(share * len(own))):
        own[k] = f"e{rng.randrange(10**6)}"
    return own


def test_similar_groups_are_those_of_all_pairs(spark):
    """Edited copies with an index from 0.75 up, whose fingerprints differ by many bits."""
    rng = random.Random(21)
    rows = []
    for i in range(60):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(20, 200))]
        rows += [(4 * i + k, " ".join(edited(rng, text, rng.choice([0, 0.005, 0.01, 0.02, 0.03])))) for k in range(3)]
    want = grouped(rows)
    assert 40 < len(rows) - len(set(want.values())) < 120
    assert {r.doc_id: r.component_id for r in similar_groups(frame(spark, rows)).collect()} == want


def test_rows_that_meet_are_all_verified(spark, monkeypatch):
    """Texts of one fingerprint or template whose smallest id is another text, and keys of more rows than a block."""
    monkeypatch.setattr(verified, "TILE", 8)
    monkeypatch.setattr(verified, "TOGETHER", 3)
    rng = random.Random(22)
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, template = draw(5) * 300, draw(120)  # of an odd number of shingles, so that no bit is even
    own = draw(150)
    rows = [(1, line + draw(150)), (2, line + own), (3, line + own[:-1] + ["other"])]
    prints = {r.fingerprint for r in simhash.fingerprints(frame(spark, [(i, " ".join(t)) for i, t in rows])).collect()}
    assert len(prints) == 1
    for i in range(40):  # pairs of like texts among texts that are half alike
        tail = draw(100) if i % 2 == 0 else tail[:-1] + ["other"]
        rows.append((100 - i, template + tail))
    rows += [(200 + i, edited(rng, template, 0.02)) for i in range(30)]
    rng.shuffle(rows)
    rows = [(i, " ".join(t)) for i, t in rows]
    want = grouped(rows)
    assert want[1] == 1 and want[3] == 2 and want[100] == 99
    assert {r.doc_id: r.component_id for r in similar_groups(frame(spark, rows)).collect()} == want


def test_chains_are_checked_where_rows_meet(spark):
    """Rows of a key of the ring are candidates by a chain and all bits, which are those within the radius."""
    from tessera.llm import minhash

    rng = np.random.default_rng(24)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    b = a.copy()
    for k in range(4000):
        for bit in rng.choice(64, k % 7, replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    ring = simhash.Ring(3, 4)
    assert ring.within(a, b).tolist() == [k % 7 <= 3 for k in range(4000)]
    # Two texts that are alike, under one key that is no band: their fingerprints decide.
    texts = frame(spark, [(1, " ".join(f"w{i}" for i in range(200))), (2, " ".join(f"w{i}" for i in range(199)))]).selectExpr("doc_id AS id", "text")
    sets = [minhash.shingle_sets(pa.array([r.text]), 5)[0] for r in texts.orderBy("id").collect()]
    for far, linked in ((0, 1), (15, 0)):
        rows = []
        for i, own in enumerate(sets):
            minima = np.full(minhash.BANDS * minhash.ROWS, 7, np.uint8)
            minima[:: minhash.ROWS] += i  # alike but for one of each band
            rows.append((i, i + 1, bytearray(minhash.set_name(own)), len(own), bytearray(minima.tobytes() + np.uint64(far * i).tobytes())))
        held = spark.createDataFrame(rows, "own long, least long, name binary, n long, sketch binary")
        close = lambda x, y: ring.within(*[np.ascontiguousarray(v).view(np.uint64)[:, 0] for v in (x, y)])
        assert minhash.set_links(texts, held, F.array(F.lit(5).cast("long")), 5, 80, 1e-9, close).count() == linked


def confusing_words():
    """Two words of 1,024 letters whose sums of powers modulo 2^64 agree under every odd base."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    return ["".join("ab"[x ^ flip] for x in bits) for flip in (0, 1)]


def test_unlike_words_stay_apart(spark):
    from tessera.llm.lm import lm_scores

    one, two = confusing_words()
    same = [f"w{i}" for i in range(12)]
    docs = frame(spark, [(1, " ".join([*same, one])), (2, " ".join([*same, two])), (3, one), (4, two)])
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()} == dict.fromkeys((1, 2, 3, 4), 0)
    assert all(r.component_id == r.doc_id for r in similar_groups(docs).filter("doc_id > 2").collect())
    # Only the ids that are learnt from are known; the end is.
    learnt = next(i for i in range(1, 50) if zlib.crc32(str(i).encode()) % 10)
    held = next(i for i in range(1, 50) if zlib.crc32(str(i).encode()) % 10 == 0)
    known = {r.doc_id: r.n_known for r in lm_scores(frame(spark, [(learnt, one), (held, two)])).collect()}
    assert known == {learnt: 2, held: 1}


def distance(item, text):
    """The least edits between the item and any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_leaks_are_exact_and_found(spark, monkeypatch):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: draw(rng.choice([14, 20, 33, 50])) for i in range(30)} | {30: ["rare"], 31: ["two", "words"], 32: [], 33: draw(8)}
    items[34] = items[0]
    docs, planted = [], 0
    for d in range(150):
        text = draw(rng.randint(0, 200))
        if d % 2:
            own = list(items[d % 30])
            for _ in range(rng.randint(0, int(0.2 * len(own)))):
                at = rng.randrange(len(own))
                own[at : at + rng.randint(0, 1)] = [f"new{d}"] * rng.randint(0, 1)
            at = rng.choice([0, len(text), rng.randrange(len(text) + 1)])
            text = text[:at] + own + text[at:]
        docs.append((d, " ".join(text).replace("w1 ", "W1, ")))
    docs += [(150, None), (151, ""), (None, " ".join(items[3])), (152, "a rare thing"), (152, "a rare thing"), (153, "Two. Words!")]
    monkeypatch.setattr(decontaminate, "ITEMS", 20)  # two passes
    monkeypatch.setattr(decontaminate, "CELLS", 5000)
    texts = spark.createDataFrame([(i, " ".join(t) if t else None, 1) for i, t in items.items()], "item_id long, text string, doc_id long")
    got = Counter((r.doc_id, r.item_id, r.edits) for r in leaks(frame(spark, docs), texts).collect())
    want = Counter()
    for d, t in docs:
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        for i, own in items.items():
            n = distance(own, w) if own else 99
            if n <= int(0.2 * len(own)):
                want[d, i, n] += 1
    assert not got - want
    assert sum((want & got).values()) >= 0.99 * sum(want.values()) > 70
    assert leaks(frame(spark, docs), texts.limit(0)).count() == 0
    assert leaks(frame(spark, []), texts).count() == 0


def test_short_leaks_without_their_first_word(spark):
    """Copies of short items whose first words are edited as much as is allowed."""
    rng = random.Random(23)
    items = {i: [f"w{rng.randrange(2000)}" for _ in range(5 + i % 9)] for i in range(90)}
    docs = []
    for i, own in items.items():
        budget = len(own) // 5
        for k, copy in enumerate((own[budget:], ["new"] * budget + own[budget:], ["new"] * budget + own)):
            docs.append((3 * i + k, " ".join(["before"] * 20 + copy + ["after"] * 20)))
    texts = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(frame(spark, docs), texts).collect()}
    assert sum((d, d // 3) in got for d, _ in docs) >= 0.98 * len(docs)


def test_empty_tables(spark, none):
    for operator in (exact_groups, remove_repeats, simhash_groups, similar_groups):
        assert operator(none).count() == 0
