import random
import zlib

from starmart.llm import language as L

SYLLABLES = {"aa": "the ing and tion er of was".split(), "bb": "der sch ung ein keit und ge".split(),
             "cc": "que ción los ado la es".split()}


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(15, 80))]
        out.append((i, " ".join(words).capitalize(), lang))
    return out


def test_held_out_accuracy_and_odd_rows(spark):
    data = rows(900, 1)
    odd = [(9000, None, "aa"), (9001, "", None), (9002, "½ ² ① 12 !? 34", "bb"), (None, "schung und keit der ein", "bb"),
           (9003, "der schung keit und ein " * 6000, None), (4, data[4][1], data[4][2]), (4, data[4][1], data[4][2])]
    docs = spark.createDataFrame([(i, t, g, 1, "x") for i, t, g in data + odd],
                                 "doc_id long, text string, lang string, score int, held_out string")
    got = L.identify_language(docs.repartition(4)).collect()
    assert len(got) == len(data) + len(odd)
    truth = {i: g for i, _, g in data}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    by_id = {r.doc_id: r for r in got}
    for i in (9000, 9001, 9002):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].accepted
    assert by_id[None].lang_pred == "bb" and by_id[None].held_out is None and by_id[9003].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_held_out_labels_are_not_used(spark):
    data = rows(300, 2)
    turned = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in data]
    kind = "doc_id long, text string, lang string"
    one = L.identify_language(spark.createDataFrame(data, kind)).collect()
    two = L.identify_language(spark.createDataFrame(turned, kind)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_narrow_margins_are_rejected():
    model = L.train([(g, t, i % 2) for i, t, g in rows(400, 3)])
    assert model.threshold > 0
    mixed = "the ing and der sch ung que los ado " * 3
    assert model.predict(mixed)[2] < model.predict("theing tioner andof wasthe oftheing ander tionwas")[2]


def test_without_labels_or_rows(spark):
    kind = "doc_id long, text string, lang string"
    plain = spark.createDataFrame([(1, "some text", None), (2, None, None)], kind)
    assert {r.lang_pred for r in L.identify_language(plain).collect()} == {"und"}
    assert L.identify_language(plain.limit(0)).count() == 0
    one = spark.createDataFrame([(i, "ein text", "de") for i in range(20)], kind)
    assert {r.lang_pred for r in L.identify_language(one).collect()} == {"de"}


def test_ties_go_to_the_first_name():
    model = L.Model(["aa", "bb"], [b"same content here", b"same content here"])
    assert model.predict("same content")[0] == "aa"


def test_dictionaries_hold_words_of_all_rows_and_of_whole_texts(spark):
    """No alphabetical or leading part: words at the end of long texts and of the last rows by name are learned."""
    tail = " ".join(f"schluss{chr(97 + i)}wort" for i in range(26))
    data = [(i, ("zz" if i % 2 else "aa") + " wort" * 4000 + " " + tail, "de") for i in range(60)]
    data += [(100 + i, "the words of " + "all day " * 30, "en") for i in range(60)]
    model = L.fit(spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(3))
    assert model.languages == ["de", "en"]
    assert set(tail.encode().split()) | {b"zz", b"aa"} <= set(model.contents[0].split())
    assert model.contents[0].split()[-1] != b"zz"  # words of few documents stand first


def test_dictionary_bytes_are_filled_by_document_count(spark, monkeypatch):
    monkeypatch.setattr(L, "DICTIONARY_BYTES", 60)
    data = [(i, "often " + "".join(chr(97 + int(c)) for c in str(1000 + i)), "de") for i in range(200)]
    model = L.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    assert model.contents[0].split()[-1] == b"often" and 50 <= len(model.contents[0]) <= 60
