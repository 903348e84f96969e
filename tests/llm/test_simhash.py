import random

import numpy as np
import pytest
import xxhash

from starmart.llm import golay
from starmart.llm import simhash as S
from starmart.llm.common import written
from starmart.llm.components import connected_components


def plain_fingerprint(text):
    words, word = [], []
    for ch in (text or ""):
        if ch in " \t\n\x0b\x0c\r":
            if word:
                words.append("".join(word))
            word = []
        else:
            word.append(ch.lower() if "A" <= ch <= "Z" else ch)
    if word:
        words.append("".join(word))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable over links of at most 3 bits."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


TEXTS = [None, "", " \n", "one", "One TWO", "a b c", "A  b\tc", "a b c d", "Ä b Ç d e", "x " * 5000, "a b c d e f"]


def test_fingerprint_against_plain_version():
    for text in TEXTS:
        assert S.fingerprint(text) == plain_fingerprint(text), text


def test_long_texts_are_hashed_in_steps():
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefgh") for _ in range(70_000))
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_golay_is_perfect():
    leader, others = golay.error_patterns()
    assert len(set(leader.tolist())) == 2048
    assert (golay.syndromes(leader) == np.arange(2048)).all()
    weight3 = np.array([int(x).bit_count() == 3 for x in leader])
    assert (others[weight3] != 0).all() and (others[~weight3] == 0).all()
    assert (golay.syndromes(others[weight3]) == np.arange(2048)[weight3, None]).all()


def test_words_one_bit_apart_share_an_index():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 23, 3000)
    other = words ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(golay.indices(words), golay.indices(other)):
        assert set(a[a >= 0]) & set(b[b >= 0])


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_linked_fingerprints_share_a_key(errors):
    rng = random.Random(errors)
    prints = [rng.getrandbits(64) for _ in range(400)]
    near = [p ^ sum(1 << b for b in rng.sample(range(64), errors)) for p in prints]
    keys, owner = S.keys(np.array(prints + near, np.uint64).view(np.int64))
    own = [set() for _ in range(800)]
    for k, o in zip(keys.tolist(), owner.tolist()):
        own[o].add(k)
    assert all(own[i] & own[i + 400] for i in range(400))


def rows_of(n, seed):
    """Random fingerprints with families of near ones, chains and a crowd."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n)]
    for p in list(prints[:40]):
        for _ in range(4):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            prints.append(p)
    crowd = rng.getrandbits(64)
    prints += [crowd ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(120)]
    return list(dict.fromkeys(prints))


@pytest.mark.parametrize("full_key", [1, 8, 128])
def test_links_have_the_components_of_all_pairs(spark, full_key):
    prints = rows_of(200, 7)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    got = {r.node: r.component for r in connected_components(S.links(df, full_key)).collect()}
    want = brute_components(prints)
    classes = {}
    for i, x in enumerate(signed):
        classes.setdefault(want[i], []).append(x)
    for members in classes.values():
        if len(members) == 1:
            assert members[0] not in got
        else:
            assert {got[m] for m in members} == {min(members)}


def signed_rows(spark, prints):
    """Written, so that Spark knows their size, as those of ``links`` are."""
    df = spark.createDataFrame([(x,) for x in np.array(prints, np.uint64).view(np.int64).tolist()], "fingerprint long")
    return written(spark, df, "test-prints")


def test_visits_of_a_crowd_are_not_broadcast(spark):
    plan = S.crowded_links(signed_rows(spark, rows_of(50, 3)))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow visited" in plan and "Broadcast" not in plan


def test_keys_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def kept(session, df, name, *args):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(session, df, name, *args)

    monkeypatch.setattr(S, "written", kept)
    S.links(signed_rows(spark, rows_of(50, 3)), 8)
    assert "MapInArrow keyed" in plans["simhash-shared"] and "Broadcast" not in plans["simhash-shared"]


def test_crowds_of_several_tasks_and_partitions(spark, monkeypatch):
    monkeypatch.setattr(S, "TASK_CROWDED", 7)
    prints = rows_of(30, 9)
    got = {frozenset((r.a, r.b)) for r in S.crowded_links(signed_rows(spark, prints)).collect()}
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    near = [{x for x, p in zip(signed, prints) if (p ^ q).bit_count() <= 3} for q in prints]
    nodes = {x for pair in got for x in pair}
    assert all(len(pair) == 2 for pair in got) and nodes == {x for x, n in zip(signed, near) if len(n) > 1}
    links = connected_components(S.crowded_links(signed_rows(spark, prints))).collect()
    want = brute_components(prints)
    classes = {}
    for x, root in zip(signed, want):
        classes.setdefault(root, []).append(x)
    assert {(r.node, r.component) for r in links} == {(x, min(c)) for c in classes.values() if len(c) > 1 for x in c}


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(1)
    chain = list(range(100, 180))
    order = chain[:]
    rng.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(79)] + [(5, x) for x in range(1000, 1100)] + [(7, 7), (8, 9), (8, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in chain} == {100} and {got[x] for x in [5, *range(1000, 1100)]} == {5}
    assert got[8] == got[9] == 8 and 7 not in got


def test_simhash_documents_against_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) + str(rng.randint(0, 40)) for _ in range(60))
            for _ in range(25)]
    texts = TEXTS + base + [b.upper() for b in base[:5]] + [b.replace(b.split()[30], "zz") for b in base]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one"), (None, "nothing like it at all")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, component_id int")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in S.simhash_components(df, 4).collect()),
                 key=str)
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    smallest = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            smallest[root] = min(i, smallest.get(root, i))
    want = sorted(((i is None, i or 0, f"{p:016x}", smallest.get(root)) for (i, _), p, root in zip(rows, prints, roots)), key=str)
    assert got == want


def test_empty_table(spark):
    assert S.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
