"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts become tokens: words, numbers and sentence ends. Numbers, names (capitalised words inside a sentence) and
units (after a number) are replaced with typed placeholders, all other words are lower-cased. Windows of ``WINDOW``
tokens are hashed by doubling (2, 4, 8 tokens), so a window costs a few integer hashes. Windows of the documents
are joined with those of the benchmark by hash; the documents that share any are looked at again, window by window:
the templates must be equal as text, and the slots consistent, i.e. over all windows of one alignment a slot value of
the item always stands for one and the same value of the document and the other way round. So a question with other
numbers or names is caught, while the same words with contradicting slots are not.

A document is contaminated by an item when at least ``MIN_WINDOWS`` different windows of the item (or all of a
shorter item) are found consistently; six windows of eight are thirteen tokens. Windows with fewer than
``MIN_WORDS`` ordinary words say too little and are left out on the benchmark side.

``contaminated`` is this rule alone. The query and the pipeline use ``leaked``, which adds what it misses: texts are looked
up by two templates, one in which every capitalised word is a name and one in which none is (case-free). Sentence starts are
read both ways on the benchmark side. Documents and items that share a window and are not decided by the rule above are
compared token by token, so names at sentence starts are slots too, and copies in other letter case are found. There only the
windows that hold a contradicting slot pair are dropped. Items of less than ``SHORT`` tokens must be found whole. Items that
no window can stand for (under four tokens, or without enough words) are found where a document is the item and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.arrays import let
from starmart.llm.common import table, written

WINDOW = 8
MIN_WINDOWS = 6
MIN_WORDS = 4
SHORT = WINDOW + MIN_WINDOWS - 1  # shorter items must be found whole
TASK_PLACES = 64  # comparisons of one task
LEAST_TOKENS, LEAST_WORDS = WINDOW // 2, 2  # of an item shorter than a window; less than that says nothing
BROADCAST_WINDOWS = 1_000_000  # up to so many hashes of benchmark windows (8 bytes each) are broadcast,
BROADCAST_ITEMS = 100_000  # and so many windows with their words and slots (some 200 bytes each)
TOKEN = r"\p{L}[\p{L}\p{M}]*+|[0-9]++(?:[.,][0-9]++)*+|[.!?\n]"
#: Words and numbers alone; a number ends with the sentence end that follows it, if one does before any other token.
SCAN_TOKEN = r"\p{L}[\p{L}\p{M}]*+|[0-9]++(?:[.,][0-9]++)*+(?:[^\p{L}0-9.!?\n]*+[.!?\n])?"
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
IS_WORD, IS_NAME, IS_FIRST, IS_NUMBER, IS_UNIT = range(5)  # IS_FIRST: capitalised at the start of a sentence
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "ton",
         "tons", "ml", "l", "liter", "liters", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h",
         "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "usd", "eur", "dollar",
         "dollars", "euro", "euros", "cent", "cents", "percent", "mph", "kmh", "degrees", "watts", "volts")


def is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def is_stop(token: Column) -> Column:
    return (token < "0") | (token == "?")


def canonical(tokens: Column, i: Column, token: Column) -> Column:
    """The placeholder or the lower-cased word of a token; NULL for a sentence end."""
    before = F.when(i > 0, tokens[i - 1])
    low = F.lower(token)
    upper = F.when(token < "a", F.lit(True)).when(token < "{", F.lit(False)).otherwise(
        F.substring(token, 1, 1) != F.substring(low, 1, 1))
    return (F.when(is_stop(token), F.lit(None).cast("string"))
            .when(is_number(token), F.lit(NUMBER))
            .when(F.coalesce(is_number(before), F.lit(False)) & low.isin(*UNITS), F.lit(UNIT))
            .when(upper & (i > 0) & ~is_stop(before), F.lit(NAME))
            .otherwise(low))


def raw_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def token_hashes(text: Column) -> Column:
    return let(raw_tokens(text), lambda tokens: F.transform(
        F.filter(F.transform(tokens, lambda t, i: canonical(tokens, i, t)), lambda t: t.isNotNull()),
        lambda t: F.xxhash64(t)))


def joined_hashes(hashes: Column, step: int) -> Column:
    """Hash of every entry with the one ``step`` places later."""
    return let(hashes, lambda h: F.transform(
        F.when(F.size(h) > step, F.slice(h, F.lit(1), F.size(h) - step)).otherwise(F.array().cast("array<bigint>")),
        lambda x, i: F.xxhash64(x, h[i + step])))


def window_hashes(hashes: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` tokens by doubling; of a shorter text none."""
    step = 1
    while step < WINDOW:
        hashes = joined_hashes(hashes, step)
        step *= 2
    return hashes


def slots_and_words(text: Column) -> Column:
    """``array<struct<word, slot>>``: canonical tokens, and the lower-cased token where it is a placeholder."""
    return let(raw_tokens(text), lambda tokens: F.filter(
        F.transform(tokens, lambda t, i: let(canonical(tokens, i, t), lambda c: F.struct(
            c.alias("word"), F.when(c.isin(NUMBER, NAME, UNIT), F.lower(t)).alias("slot")))),
        lambda s: s["word"].isNotNull()))


def windows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per window: the keys, ``pos``, ``hash``, ``words`` and ``slots``."""
    both = df.select(*keys, slots_and_words(F.col("text")).alias("tokens"))
    both = both.withColumn("hashes", window_hashes(F.transform("tokens", lambda t: F.xxhash64(t["word"]))))
    each = F.transform("hashes", lambda h, i: let(F.slice("tokens", i + 1, WINDOW), lambda part: F.struct(
        i.alias("pos"), h.alias("hash"), F.transform(part, lambda t: t["word"]).alias("words"),
        F.transform(part, lambda t: t["slot"]).alias("slots"))))
    return both.select(*keys, F.inline(each))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the items with at least ``MIN_WORDS`` words, and how many such windows each item has.

    Items with the same id and text count once. An item shorter than a window has none and is never found.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "text"))
    words = F.size(F.filter("words", lambda w: ~w.isin(NUMBER, NAME, UNIT)))
    rows = windows(items, ["item_id", "item_key", "text"]).drop("text").where(words >= MIN_WORDS)
    totals = rows.groupBy("item_key").agg(F.count(F.lit(1)).alias("item_windows"))
    return rows.join(totals, "item_key")


def suspected(docs: DataFrame, hashes: DataFrame, count: int, of_text) -> DataFrame:
    """``doc_id, text, text_hash`` of the documents with any of ``count`` hashes among those of ``of_text``."""
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    found = (texts.select("doc_id", F.xxhash64("text").alias("text_hash"),
                          F.explode(of_text(F.col("text"))).alias("hash"))
             .join(F.broadcast(hashes) if count <= BROADCAST_WINDOWS else hashes, "hash", "left_semi")
             .select("doc_id", "text_hash").distinct())
    found = written(docs.sparkSession, found, "contamination-candidates")
    return texts.withColumn("text_hash", F.xxhash64("text")).join(
        found.withColumnsRenamed({"doc_id": "found_id", "text_hash": "found_hash"}),
        F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left_semi")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated`` by text: ``doc_id, text_hash, item_id, matched_windows, item_windows, exact``."""
    items = written(docs.sparkSession, benchmark_windows(benchmark), "benchmark-windows")
    count = items.count()
    suspects = suspected(docs, items.select("hash").distinct(), count, lambda t: window_hashes(token_hashes(t)))
    return template_matches(suspects, items, count)


def template_matches(suspects: DataFrame, items: DataFrame, count: int) -> DataFrame:
    at = windows(suspects, ["doc_id", "text_hash", "text"]).drop("text")
    item = (F.broadcast(items) if count <= BROADCAST_ITEMS else items).select(
        "item_key", "item_id", "item_windows", F.col("pos").alias("item_pos"), "hash",
        F.col("words").alias("item_words"), F.col("slots").alias("item_slots"))
    hits = at.join(item, "hash").where(F.col("words") == F.col("item_words"))
    pairs = F.filter(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                     lambda p: p["a"].isNotNull())
    by_alignment = (hits.select("doc_id", "text_hash", "item_key", "item_id", "item_windows", "item_pos",
                                (F.col("pos") - F.col("item_pos")).alias("shift"), pairs.alias("pairs"))
                    .groupBy("doc_id", "text_hash", "item_key", "item_id", "item_windows", "shift")
                    # at most as many entries as the item has windows
                    .agg(F.collect_set("item_pos").alias("positions"),
                         F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    values = F.size("pairs")
    consistent = ((F.size(F.array_distinct(F.transform("pairs", lambda p: p["a"]))) == values)
                  & (F.size(F.array_distinct(F.transform("pairs", lambda p: p["b"]))) == values))
    same = F.forall("pairs", lambda p: p["a"] == p["b"])
    each = (by_alignment.where(consistent)
            .select("doc_id", "text_hash", "item_key", "item_id", "item_windows", same.alias("same"),
                    F.explode("positions").alias("item_pos"))
            .groupBy("doc_id", "text_hash", "item_key", "item_id", "item_windows")
            .agg(F.count_distinct("item_pos").alias("matched_windows"), F.min("same").alias("exact")))
    enough = F.col("matched_windows") >= F.least(F.lit(MIN_WINDOWS), F.col("item_windows"))
    return each.where(enough).select("doc_id", "text_hash", "item_key", "item_id", "matched_windows", "item_windows", "exact")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated documents: ``doc_id, item_id, matched_windows, item_windows, exact``.

    ``exact`` is true when all matched slots have the item's own values. NULL and empty texts, and documents or
    items shorter than a window, are never contaminated; rows with a NULL id are matched like others; repeated rows
    give one result; extra columns are ignored; empty tables give no rows.
    """
    return by_document(matches(docs, benchmark))


def by_document(found: DataFrame) -> DataFrame:
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("matched_windows").alias("matched_windows"), F.max("item_windows").alias("item_windows"),
                 F.max("exact").alias("exact")))


def typed_tokens(text: Column, words: bool = True) -> Column:
    """``array<struct<kind, hash[, low]>>`` without sentence ends; ``hash`` is that of the case-free token."""
    def typed(tokens: Column, t: Column, i: Column) -> Column:
        before, low = F.when(i > 0, tokens[i - 1]), F.lower(t)
        upper = F.when(t < "a", F.lit(True)).when(t < "{", F.lit(False)).otherwise(
            F.substring(t, 1, 1) != F.substring(low, 1, 1))
        kind = (F.when(is_number(t), F.lit(IS_NUMBER))
                .when(F.coalesce(is_number(before), F.lit(False)) & low.isin(*UNITS), F.lit(IS_UNIT))
                .when(upper, F.when((i > 0) & ~is_stop(before), F.lit(IS_NAME)).otherwise(F.lit(IS_FIRST)))
                .otherwise(F.lit(IS_WORD)))
        free = F.when(is_number(t), F.lit(NUMBER)).when(
            F.coalesce(is_number(before), F.lit(False)) & low.isin(*UNITS), F.lit(UNIT)).otherwise(low)
        word = F.struct(kind.alias("kind"), F.xxhash64(free).alias("hash"), *([low.alias("low")] if words else []))
        return F.when(~is_stop(t), word)

    return let(raw_tokens(text), lambda tokens: F.filter(
        F.transform(tokens, lambda t, i: typed(tokens, t, i)), lambda t: t.isNotNull()))


def template_hashes(tokens: Column, own: bool = False) -> list[Column]:
    """Token hashes by template: all capitalised words as names, and no names (case-free).

    With ``own``, for the benchmark side, also those in which sentence starts are words, and the first token a name.
    """
    name = F.xxhash64(F.lit(NAME))

    def named(*kinds: int) -> Column:
        return F.transform(tokens, lambda t: F.when(t["kind"].isin(*kinds), name).otherwise(t["hash"]))

    templates = [named(IS_NAME, IS_FIRST), F.transform(tokens, lambda t: t["hash"])]
    if own:
        first = F.transform(tokens, lambda t, i: F.when(t["kind"].isin(IS_NAME, IS_FIRST) | (
            (i == 0) & (t["kind"] == IS_WORD)), name).otherwise(t["hash"]))
        templates += [named(IS_NAME), first]
    return templates


def sequence_hashes(hashes: Column, length: int) -> Column:
    """Hashes of all sequences of ``length`` tokens, from half a window to less than a window."""
    step = 1
    while step < WINDOW // 2:
        hashes = joined_hashes(hashes, step)
        step *= 2
    return joined_hashes(hashes, length - WINDOW // 2)


def text_hashes(text: Column, lengths: list[int]) -> Column:
    """The hashes of a text by all templates: windows, and the sequences as long as a shorter item."""
    return let(typed_tokens(text, words=False), lambda tokens: F.concat(F.array(whole_hash(tokens)), *(
        x for h in template_hashes(tokens) for x in (window_hashes(h), *(sequence_hashes(h, n) for n in lengths)))))


def whole_hash(tokens: Column) -> Column:
    """One hash of the whole case-free text."""
    return F.xxhash64(F.lit(0), F.transform(tokens, lambda t: t["hash"]))


def is_plain(token: Column) -> Column:
    return ~token["kind"].isin(IS_NUMBER, IS_UNIT)


def placed_hashes(tokens: Column, lengths: list[int], own: bool = False) -> Column:
    """``array<struct<pos, hash>>`` of ``text_hashes``, repeats included; with ``own`` only sequences that are the whole text."""
    def placed(hashes: Column) -> Column:
        return F.transform(hashes, lambda x, i: F.struct(i.alias("pos"), x.alias("hash")))

    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    # no array_distinct: on structs it compares every entry with all before it
    return let(tokens, lambda t: F.concat(*(
        x for h in template_hashes(t, own) for x in (placed(window_hashes(h)), *(
            F.when(F.size(t) == n, placed(sequence_hashes(h, n))).otherwise(none) if own
            else placed(sequence_hashes(h, n)) for n in lengths)))))


def benchmark_tokens(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_key, tokens, width, whole, starts, keyed``: the items, how wide their windows are, and where those that
    count and those that are looked up start.

    Windows with ``MIN_WORDS`` words are looked up. In an item of ``SHORT`` or more tokens only these count; in a
    shorter one all do, so its whole sequence is compared. An item shorter than a window is one window. An item without a
    window to look up has ``keyed`` empty; ``whole`` is the hash of its tokens.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    items = items.select("item_id", F.xxhash64("item_id", "text").alias("item_key"),
                         typed_tokens(F.col("text")).alias("tokens"))
    size = F.size("tokens")
    items = items.where(size > 0).withColumn("width", F.least(size, F.lit(WINDOW)))
    every = F.when(size >= LEAST_TOKENS, F.sequence(F.lit(0), size - F.col("width"))).otherwise(F.array().cast("array<int>"))
    words = F.when(size < WINDOW, F.lit(LEAST_WORDS)).otherwise(F.lit(MIN_WORDS))
    items = items.withColumn("whole", whole_hash(F.col("tokens")))
    keyed = F.filter(every, lambda i: F.size(F.filter(F.slice("tokens", i + 1, F.col("width")), is_plain)) >= words)
    items = items.withColumn("keyed", keyed)
    return items.withColumn("starts", F.when(size < SHORT, every).otherwise(F.col("keyed")))


def looked_up(items: DataFrame) -> DataFrame:
    """``item_key, item_pos, hash`` of the windows of ``benchmark_tokens``."""
    own = placed_hashes(F.col("tokens"), list(range(LEAST_TOKENS, WINDOW)), own=True)
    return (items.select("item_key", "keyed", F.inline(own)).where(F.array_contains("keyed", F.col("pos")))
            .select("item_key", F.col("pos").alias("item_pos"), "hash").distinct())


def group_size(width: int) -> tuple[int, int]:
    """How many tokens a group of the scan has and how far apart groups start, so that any ``width`` tokens hold one whole."""
    stride = width // 2
    return width - stride + 1, stride


def groups_of(hashes: Column, size: int, stride: int = 1) -> Column:
    """Hashes of the groups of ``size`` tokens that start at every ``stride``-th token."""
    return F.when(F.size(hashes) >= size, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size, F.lit(stride)),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))))).otherwise(F.array().cast("array<bigint>"))


def end_hash(hashes: Column) -> Column:
    """A hash that texts with the same case-free tokens have in common."""
    return F.xxhash64(F.lit(0), F.size(hashes), F.get(hashes, F.lit(0)), F.get(hashes, F.size(hashes) - 1))


def scan_hashes(text: Column, width: int) -> Column:
    """What the scan looks up of a document: ``end_hash``, and its groups by both templates of ``template_hashes``."""
    size, stride = group_size(width)
    number, unit, name = (F.xxhash64(F.lit(x)) for x in (NUMBER, UNIT, NAME))

    def free(tokens: Column, t: Column, i: Column) -> Column:
        before, low = F.get(tokens, i - 1), F.lower(t)
        after_number = F.coalesce(is_number(before) & F.substring(before, -1, 1).between("0", "9"), F.lit(False))
        return F.when(is_number(t), number).when(low.isin(*UNITS) & after_number, unit).otherwise(F.xxhash64(low))

    def named(t: Column, h: Column) -> Column:
        upper = (t < "a") | (F.substring(t, 1, 1) != F.substring(F.lower(t), 1, 1))
        return F.when((t >= "a") & (t < "{"), h).when((h != number) & (h != unit) & upper, name).otherwise(h)

    return let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SCAN_TOKEN), F.lit(0)), lambda tokens: let(
        F.transform(tokens, lambda t, i: free(tokens, t, i)), lambda h: F.concat(
            F.array(end_hash(h)), groups_of(h, size, stride), let(F.zip_with(tokens, h, named), lambda n: groups_of(n, size, stride)))))


def scanned_for(items: DataFrame, tokens: DataFrame, width: int) -> DataFrame:
    """``hash``: what ``scan_hashes`` of a document has where it shares a window with an item (``items``: ``benchmark_windows``,
    ``tokens``: ``benchmark_tokens``), or is one that no window can stand for."""
    size, _ = group_size(width)

    def placed(hashes: Column) -> Column:
        return F.transform(groups_of(hashes, size), lambda x, i: F.struct(i.alias("pos"), x.alias("hash")))

    own = F.concat(*(placed(h) for h in template_hashes(F.col("tokens"), own=True)))
    looked = (tokens.select("keyed", "width", F.inline(own))
              .where(F.exists("keyed", lambda k: (F.col("pos") >= k) & (F.col("pos") + size <= k + F.col("width")))))
    windows_ = items.select(F.explode(groups_of(F.transform("words", lambda w: F.xxhash64(w)), size)).alias("hash"))
    whole = tokens.where(F.size("keyed") == 0).select(end_hash(F.transform("tokens", lambda t: t["hash"])).alias("hash"))
    return looked.select("hash").union(windows_).union(whole).distinct()


def compared(item: Column, doc: Column, shift: Column) -> Column:
    """The item's tokens beside the document's: ``array<struct<fits, equal, plain, name, a, b>>``.

    Equal words fit whatever their case, numbers fit numbers, units units, and capitalised words capitalised words,
    also at the start of a sentence. ``a`` and ``b`` are the slot values of both sides, NULL for ordinary words.
    """
    def one(x: Column, y: Column) -> Column:
        equal = F.coalesce(x["low"] == y["low"], F.lit(False))
        plain = is_plain(x)
        name = x["kind"].isin(IS_NAME, IS_FIRST)
        fits = equal | F.coalesce(F.when(plain, name & y["kind"].isin(IS_NAME, IS_FIRST))
                                  .otherwise(x["kind"] == y["kind"]), F.lit(False))
        slot = name | ~plain
        return F.struct(fits.alias("fits"), equal.alias("equal"), plain.alias("plain"), name.alias("name"),
                        F.when(slot, x["low"]).alias("a"), F.when(slot, y["low"]).alias("b"))

    return F.transform(item, lambda x, i: one(x, F.get(doc, i + shift)))


def good_pairs(pairs: Column) -> Column:
    """The slot pairs of an alignment that hold: the most frequent partner of each item value (of equally frequent
    ones the same value, then the least) and, for names, also of each document value. Different numbers may become
    the same one."""
    counted = let(pairs, lambda all_: F.transform(F.array_distinct(all_), lambda p: F.struct(
        F.size(F.filter(all_, lambda q: q == p)).alias("n"), (p["a"] == p["b"]).alias("same"), p.alias("p"))))

    def beaten(p: Column, e: Column) -> Column:
        rival = lambda q: (((q["p"]["a"] == p["p"]["a"]) & (q["p"]["b"] != p["p"]["b"]))
                           | (p["p"]["name"] & q["p"]["name"] & (q["p"]["b"] == p["p"]["b"])
                              & (q["p"]["a"] != p["p"]["a"])))
        order = lambda q, than: (q["n"] > than["n"]) | ((q["n"] == than["n"]) & (
            (q["same"] & ~than["same"]) | ((q["same"] == than["same"]) & (
                F.concat_ws(" ", q["p"]["b"], q["p"]["a"]) < F.concat_ws(" ", than["p"]["b"], than["p"]["a"])))))
        return F.exists(e, lambda q: rival(q) & order(q, p))

    return let(counted, lambda e: F.transform(F.filter(e, lambda p: ~beaten(p, e)), lambda p: p["p"]))


def counting_windows(both: Column, starts: Column, width: Column) -> Column:
    """``array<struct<item_pos, same>>``: the windows that fit and hold no contradicting slot pair.

    A window needs ``MIN_WORDS`` equal words; a word for word copy of one in a short item does not.
    Every step is bound once (``let``), so that the optimizer does not repeat it inside the next one.
    """
    def window(i: Column) -> Column:
        return F.slice(both, i + 1, width)

    fitting = F.filter(starts, lambda i: let(window(i), lambda w: F.forall(w, lambda t: t["fits"]) & (
        (F.size(F.filter(w, lambda t: t["equal"] & t["plain"])) >= MIN_WORDS)
        | ((F.size(both) < SHORT) & F.forall(w, lambda t: t["equal"])))))

    def pairs(fits: Column) -> Column:
        return F.transform(F.filter(F.transform(both, lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
                                    lambda x: x["t"]["a"].isNotNull() & F.exists(
                                        fits, lambda j: (j <= x["i"]) & (x["i"] < j + width))),
                           lambda x: F.struct(x["t"]["a"].alias("a"), x["t"]["b"].alias("b"),
                                              x["t"]["name"].alias("name")))

    def agreeing(fits: Column, good: Column) -> Column:
        def one(i: Column) -> Column:
            slots = F.filter(window(i), lambda t: t["a"].isNotNull())
            return let(slots, lambda w: let(F.forall(w, lambda t: t["a"] == t["b"]), lambda same: F.when(
                same | F.forall(w, lambda t: F.exists(good, lambda g: (g["a"] == t["a"]) & (g["b"] == t["b"]))),
                F.struct(i.alias("item_pos"), same.alias("same")))))

        return F.filter(F.transform(fits, one), lambda w: w.isNotNull())

    return let(fitting, lambda fits: let(good_pairs(pairs(fits)), lambda good: agreeing(fits, good)))


def whole_matches(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that are an item which no window can stand for, in any letter case."""
    short = items.where(F.size("keyed") == 0).select("item_key", "item_id", "whole", "tokens")
    own = tokens.select("doc_id", "text_hash", "doc_tokens", whole_hash(F.col("doc_tokens")).alias("whole"))
    low = lambda c: F.transform(c, lambda t: t["low"])
    return own.join(short, "whole").select(
        "doc_id", "text_hash", "item_key", "item_id", F.lit(1).cast("long").alias("matched_windows"), F.lit(1).alias("item_windows"),
        (low(F.col("tokens")) == low(F.col("doc_tokens"))).alias("exact"))


def aligned_matches(tokens: DataFrame, items: DataFrame, decided: DataFrame, count: int, lengths: list[int]) -> DataFrame:
    """Matches token by token: every place where a window of an item and one of a document have a common template is
    compared over the whole item; windows count whose tokens fit, with ``MIN_WORDS`` equal words and agreeing slots.
    Pairs of document and item that are ``decided`` are left out before the comparison."""
    spark = tokens.sparkSession
    item_at = looked_up(items)
    places = (tokens.select("doc_id", "text_hash", F.inline(placed_hashes(F.col("doc_tokens"), lengths)))
              .join(F.broadcast(item_at) if count <= BROADCAST_ITEMS else item_at, "hash")
              .select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "item_key",
                      (F.col("pos") - F.col("item_pos")).alias("shift")))
    known = decided.select(F.col("doc_id").alias("known_id"), F.col("text_hash").alias("at_hash"), "item_key").distinct()
    places = places.join(known, (known["known_id"].eqNullSafe(places["at_id"])) & (known["at_hash"] == places["at_hash"])
                         & (known["item_key"] == places["item_key"]), "left_anti").distinct()
    places = written(spark, places, "contamination-places")
    # a comparison takes much longer than reading its row, so the rows are dealt out by number, not by size
    places = places.repartition(max(1, -(-places.count() // TASK_PLACES)), "at_hash", "item_key", "shift")
    rows = (places.join(tokens, F.col("at_id").eqNullSafe(F.col("doc_id")) & (F.col("at_hash") == F.col("text_hash")))
            .join(F.broadcast(items) if count <= BROADCAST_ITEMS else items, "item_key")
            .select("doc_id", "text_hash", "item_key", "item_id", "starts",
                    let(compared(F.col("tokens"), F.col("doc_tokens"), F.col("shift")),
                        lambda both: counting_windows(both, F.col("starts"), F.col("width"))).alias("windows")))
    # written first: the filter that Spark derives from a generator would compute the comparison several times over
    rows = written(spark, rows, "contamination-windows")
    each = (rows.select("doc_id", "text_hash", "item_key", "item_id", F.size("starts").alias("item_windows"),
                        F.inline("windows"))
            .groupBy("doc_id", "text_hash", "item_key", "item_id", "item_windows")
            .agg(F.count_distinct("item_pos").alias("matched_windows"), F.min("same").alias("exact")))
    enough = F.col("matched_windows") >= F.least(F.lit(MIN_WINDOWS), F.col("item_windows"))
    return each.where(enough).select("doc_id", "text_hash", "item_key", "item_id", "matched_windows", "item_windows", "exact")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``matches`` and, for pairs of document and item without one, ``aligned_matches`` and ``whole_matches``; the documents are
    scanned once for all."""
    spark = docs.sparkSession
    items = written(spark, benchmark_windows(benchmark), "benchmark-windows")
    tokens = written(spark, benchmark_tokens(benchmark), "benchmark-tokens")
    count = items.count()
    lengths = sorted(r["width"] for r in tokens.select("width").where(
        (F.col("width") < WINDOW) & (F.size("keyed") > 0)).distinct().collect())
    hashes = looked_up(tokens).select("hash").union(tokens.where(F.size("keyed") == 0).select("whole"))
    hashes = written(spark, hashes.union(items.select("hash")).distinct(), "benchmark-hashes")
    wide = hashes.count()
    width = min([*lengths, WINDOW])
    groups = written(spark, scanned_for(items, tokens, width), "benchmark-groups")
    scanned = written(spark, suspected(docs, groups, groups.count(), lambda t: scan_hashes(t, width)), "contamination-scanned")
    suspects = suspected(scanned, hashes, wide, lambda t: text_hashes(t, lengths))
    suspects = written(spark, suspects, "contamination-suspects")
    found = written(spark, template_matches(suspects, items, count), "contamination-found")
    doc_tokens = written(spark, suspects.select(
        "doc_id", "text_hash", typed_tokens(F.col("text")).alias("doc_tokens")).distinct(), "contamination-tokens")
    rows = (found.unionByName(aligned_matches(doc_tokens, tokens, found, wide, lengths))
            .unionByName(whole_matches(doc_tokens, tokens)))
    best = F.max(F.struct("matched_windows", "item_windows", "exact"))
    return rows.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("m")).select(
        "doc_id", "text_hash", "item_id", "m.matched_windows", "m.item_windows", "m.exact")


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated`` by the wider rule of ``leaks``."""
    return by_document(leaks(docs, benchmark))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that no benchmark item contaminates.

    NULL and empty texts are never contaminated and stay, as do repeated rows (all or none); a NULL id is an id like any other
    here. An empty table stays empty, and without items every row stays.
    """
    found = written(docs.sparkSession, leaks(docs, benchmark).select(
        F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["found_id"])
                     & (F.xxhash64(docs["text"]) == found["found_hash"]), "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
