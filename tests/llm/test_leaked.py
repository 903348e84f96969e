"""The wider decontamination rule against a plain version of it."""

from __future__ import annotations

import random
import re
from collections import Counter

from starmart.llm import decontamination as D

STOP = {".", "!", "?", "\n"}


def typed(text):
    """``kind, word, free`` of the tokens, without sentence ends; ``free`` is the case-free token."""
    raw = re.findall(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*|[.!?\n]", text)
    out = []
    for i, t in enumerate(raw):
        low, before = t.lower(), raw[i - 1] if i else None
        if t in STOP:
            continue
        if t[0].isdigit():
            out.append((D.IS_NUMBER, low, D.NUMBER))
        elif before and before[0].isdigit() and low in D.UNITS:
            out.append((D.IS_UNIT, low, D.UNIT))
        elif t[0] != low[0]:
            out.append((D.IS_NAME if i and before not in STOP else D.IS_FIRST, low, low))
        else:
            out.append((D.IS_WORD, low, low))
    return out


def templates(tokens, own=False):
    named = lambda *kinds: [D.NAME if k in kinds else free for k, _, free in tokens]
    out = [named(D.IS_NAME, D.IS_FIRST), [free for *_, free in tokens]]
    if own:
        first = named(D.IS_NAME, D.IS_FIRST)
        out += [named(D.IS_NAME), [D.NAME if tokens[0][0] == D.IS_WORD else first[0], *first[1:]]]
    return out


def plain(token):
    return token[0] not in (D.IS_NUMBER, D.IS_UNIT)


def compare(a, b, shift, starts, width):
    """The windows of an item that count at one place of a document, and whether each has the item's own values."""
    both = []
    for i, x in enumerate(a):
        y = b[i + shift] if 0 <= i + shift < len(b) else None
        name = x[0] in (D.IS_NAME, D.IS_FIRST)
        equal = y is not None and x[1] == y[1]
        fits = equal or (y is not None and ((name and y[0] in (D.IS_NAME, D.IS_FIRST)) if plain(x) else x[0] == y[0]))
        slot = (x[1], y[1] if y else None, name) if name or not plain(x) else None
        both.append((fits, equal, plain(x), slot))
    fitting = [i for i in starts if all(t[0] for t in both[i:i + width]) and (
        sum(t[1] and t[2] for t in both[i:i + width]) >= D.MIN_WORDS
        or (len(a) < D.SHORT and all(t[1] for t in both[i:i + width])))]
    covered = {k for i in fitting for k in range(i, i + width)}
    pairs = Counter(both[k][3] for k in covered if both[k][3])

    def better(q, p):
        return (-pairs[q], q[0] != q[1], f"{q[1]} {q[0]}") < (-pairs[p], p[0] != p[1], f"{p[1]} {p[0]}")

    good = {(p[0], p[1]) for p in pairs if not any(
        better(q, p) and ((q[0] == p[0] and q[1] != p[1]) or (p[2] and q[2] and q[1] == p[1] and q[0] != p[0])) for q in pairs)}
    out = {}
    for i in fitting:
        slots = [t[3] for t in both[i:i + width] if t[3]]
        same = all(a == b for a, b, _ in slots)
        if same or all((a, b) in good for a, b, _ in slots):
            out[i] = same
    return out


def brute(docs, items, by_rule):
    """``by_rule``: what the narrower rule finds; pairs it has are not looked at again."""
    found = dict(by_rule)
    for doc_id, text in docs:
        b = typed(text)
        for item_id, item in items:
            a = typed(item)
            if (doc_id, item_id) in by_rule or not a:
                continue
            width = min(len(a), D.WINDOW)
            every = list(range(len(a) - width + 1)) if len(a) >= D.LEAST_TOKENS else []
            least = D.LEAST_WORDS if len(a) < D.WINDOW else D.MIN_WORDS
            keyed = [i for i in every if sum(map(plain, a[i:i + width])) >= least]
            if not keyed:
                if [t[2] for t in a] == [t[2] for t in b]:
                    found[doc_id, item_id] = (1, 1, [t[1] for t in a] == [t[1] for t in b])
                continue
            starts = every if len(a) < D.SHORT else keyed
            shifts = {j - i for i in keyed for j in range(len(b) - width + 1)
                      for x in templates(a, own=True) for y in templates(b) if x[i:i + width] == y[j:j + width]}
            windows = {}
            for shift in shifts:
                for i, same in compare(a, b, shift, starts, width).items():
                    windows[i] = min(same, windows.get(i, True))
            if windows and len(windows) >= min(D.MIN_WINDOWS, len(starts)):
                found[doc_id, item_id] = (len(windows), len(starts), min(windows.values()))
    return found


def rows(got):
    return {(r.doc_id, r.item_id): (r.matched_windows, r.item_windows, r.exact) for r in got.collect()}


def test_random_texts_against_the_plain_rule(spark):
    rng = random.Random(9)
    words = ["red", "blue", "Paris", "Rome", "7", "3.5", "kg", "runs", "Éa", "was", "the", "of", ".", "\n", "green", "Old", "sings"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 7, 9, 12, 14, 25, 40])))) for i in range(40)]
    docs = [(1000 + i, t) for i, t in items[:6]]
    for d in range(50):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
        part = rng.choice(items)[1]
        change = rng.choice([str, str.upper, str.lower, str.title, lambda t: t.replace("Paris", "Oslo").replace("7", "9"),
                             lambda t: t.replace("Paris", "Oslo", 1), lambda t: t.replace("Rome", "Paris").replace("Old", "New")])
        docs.append((d, f"{text} {rng.choice(['', '. '])}{change(part)} {text}"))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    by_rule = rows(D.contaminated(d, i))
    got = rows(D.leaked(d, i))
    assert got == brute(docs, items, by_rule)
    assert len(got) > len(by_rule) + 5


def test_items_that_no_window_stands_for(spark):
    items = [(1, "Why?"), (2, "2 + 3"), (3, "1 2 3 4 5 6 7 8 9 10"), (4, ""), (5, "...")]
    docs = [(1, "why"), (2, "so why not"), (3, "2 + 3!"), (4, "2 + 4"), (5, "1 2 3 4 5 6 7 8 9 10."), (6, "1 2 3"), (7, ""), (8, None)]
    got = rows(D.leaked(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string")))
    assert got == {(1, 1): (1, 1, True), (3, 2): (1, 1, True), (4, 2): (1, 1, False), (5, 3): (1, 1, True)}


def test_kept_rows(spark):
    item = "A train from Springfield to Shelbyville travels far and then returns to Springfield at half the speed of before."
    docs = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, None, "x"), (2, "", "x"), (None, item, "x"), (None, "b", "x")],
                                 "doc_id long, text string, found_id string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(map(tuple, D.without_contaminated(docs, items).collect()), key=str) == sorted(
        [(2, None, "x"), (2, "", "x"), (None, "b", "x")], key=str)
    assert D.without_contaminated(docs, items.limit(0)).count() == 6
    assert D.without_contaminated(docs.limit(0), items).count() == 0


def test_scan_finds_every_document_with_a_common_window(spark):
    """A document is looked up by a group of every few tokens, and none that shares a window is lost by that."""
    from pyspark.sql import functions as F
    from starmart.llm.common import written

    rng = random.Random(11)
    words = ["red", "Blue", "PARIS", "Rome", "7", "3.5", "5.", "4 )?", "kg", "KG", "Day", "Éa", "éa", "was", "İx", "of", ".", "\n", "áb"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(1, 30))) for i in range(25)] + [(30, "1 2 3"), (31, None), (32, "")]
    docs = []
    for d in range(150):
        item = rng.choice(items)[1] or ""
        changed = (item, item.upper(), item.lower(), item.replace("Rome", "Oslo").replace("7", "8"))[d % 4]
        docs.append((d, changed if d % 5 == 0 else f"{text(rng.randint(0, 9))} {changed} {text(rng.randint(0, 9))}"))
    docs += [(200, None), (201, ""), (202, "1 2 3")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    own, tokens = D.benchmark_windows(benchmark), D.benchmark_tokens(benchmark)
    tokens = written(spark, tokens, "test-tokens")
    lengths = sorted(r["width"] for r in tokens.where((F.col("width") < D.WINDOW) & (F.size("keyed") > 0)).select("width").distinct().collect())
    every = D.looked_up(tokens).select("hash").union(tokens.where(F.size("keyed") == 0).select("whole")).union(own.select("hash")).distinct()
    exact = D.suspected(docs, every, 1, lambda t: D.text_hashes(t, lengths))
    width = min([*lengths, D.WINDOW])
    scanned = D.suspected(docs, D.scanned_for(own, tokens, width), 1, lambda t: D.scan_hashes(t, width))
    ids = lambda df: {r.doc_id for r in df.collect()}
    assert lengths and len(ids(exact)) > 60 and ids(exact) <= ids(scanned)
    long = spark.createDataFrame([(" ".join(f"w{i}" for i in "abcdefghij" * 40),)], "text string")
    assert long.select(F.size(D.scan_hashes(F.col("text"), D.WINDOW))).first()[0] <= 400 // 2 + 1


def test_places_of_a_long_document_take_linear_time(spark):
    from pyspark.sql import functions as F

    assert "array_distinct" not in str(D.placed_hashes(D.typed_tokens(F.col("text")), [5]))
