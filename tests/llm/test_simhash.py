import random
import re

import numpy as np
import xxhash

from fareloom.llm import simhash
from tests.llm.conftest import PROSE, rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, threshold=3):
    """Smallest id of each pair's component, from (id, fingerprint) pairs."""
    group = list(range(len(pairs)))
    for i in range(len(pairs)):
        for j in range(i):
            if bin(pairs[i][1] ^ pairs[j][1]).count("1") <= threshold and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(pairs, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [least.get(g) for g in group]


def test_fingerprints_equal_a_plain_count():
    for text in ["", " ", "One", "one two", "A b C", "A b C d", PROSE, "É é Ä x y", "a a a a a a", "x\x1cy z\x85w"]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_code_covers_and_replicas_meet():
    near, _ = simhash._error_tables()
    assert len(set(simhash._syndrome(np.arange(1 << 11)).tolist())) == 1 << 11
    assert (np.bitwise_count(near) <= 3).all() and (near > 0).sum() == (1 << 11) - 1


def chain(n, seed):
    """Fingerprints with links of 0 to 5 bits between them."""
    drawn = random.Random(seed)
    prints = [drawn.getrandbits(64) for _ in range(n // 6)]
    while len(prints) < n:
        p = drawn.choice(prints)
        for _ in range(drawn.randint(0, 5)):
            p ^= 1 << drawn.randrange(64)
        prints.append(p)
    return prints


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOMES_PER_SHARE", 3)
    monkeypatch.setattr(simhash, "_BLOCK_PAIRS", 8)
    prints = sorted(set(chain(300, 13)) | {(1 << 64) - 1 ^ 1 << b for b in range(20)})
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(frame).collect()
    for r in found:
        assert r["a"] != r["b"]
    roots = {r["node"]: r["root"] for r in simhash.connected(simhash.links(frame)).collect()}
    wanted = plain_components(list(enumerate(prints)))
    groups = {}
    for p, w in zip(signed, wanted):
        groups.setdefault(roots.get(p, p), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(wanted))


def test_components_of_small_graphs(spark):
    edges = [(1, 2), (2, 3), (9, 3), (7, 8), (8, 7), (30, 20), (20, 10), (10, 40), (40, 5)]
    found = simhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {2: 1, 3: 1, 9: 1, 8: 7, 10: 5, 20: 5, 30: 5, 40: 5}
    line = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["root"] for r in simhash.connected(line).collect()} == {0}
    assert simhash.connected(line.limit(0)).count() == 0


def test_documents_equal_brute_force(spark, odd_documents, no_documents):
    drawn = random.Random(14)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(drawn.choice(words) for _ in range(200)) for _ in range(8)]
    docs = []
    for i in range(80):
        parts = drawn.choice(texts).split()
        if drawn.random() < 0.6:
            parts[drawn.randrange(200)] = "changed"
        docs.append((i * 3 % 80, " ".join(parts), "en"))
    for frame in (rows(spark, docs), odd_documents):
        given = [(r["doc_id"], plain_fingerprint(r["text"])) for r in frame.collect()]
        wanted = sorted(((i, format(f, "016x"), c) for (i, f), c in zip(given, plain_components(given))), key=repr)
        assert sorted((tuple(r) for r in simhash.near_duplicates(frame).collect()), key=repr) == wanted
    assert simhash.near_duplicates(no_documents).count() == 0


def test_one_of_each(odd_documents):
    left = simhash.one_of_each(odd_documents)
    assert left.schema == odd_documents.schema
    ids = [r["doc_id"] for r in left.collect()]
    # Two components may have one smallest id, where an id has several texts.
    roots = {r["root"]: r["component_id"] for r in simhash.components(odd_documents).collect()}
    assert sorted(ids, key=repr) == sorted(roots.values(), key=repr)
