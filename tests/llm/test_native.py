import random

import cases
from pyspark.sql import functions as F

from tagloom.llm import chat, decontam, rules


def test_measures_of_hostile_texts(spark):
    import re

    got = {}
    for r in rules.measures(cases.frame(spark, cases.unique_ids())).collect():
        got[r.doc_id] = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    for d, t in cases.unique_ids():
        w = [x.decode() for x in t.encode().split()]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + o for i, g in enumerate(grams) for o in range(3) if grams.count(g) > 1} if len(grams) < 7000 else None
        full = [x for x in t.split("\n") if x.encode().split()]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(again))
        assert got[d] == want, d


def test_long_texts_sort_pairs(spark, monkeypatch):
    rows = [(1, "a b c d a b c x y"), (2, "a b c"), (3, " ".join(["z"] * 9))]
    docs = cases.frame(spark, rows)
    short = sorted(rules.measures(docs).select("doc_id", "n_repeat_words").collect())
    monkeypatch.setattr(rules, "INDEX_BITS", 1)
    assert sorted(rules.measures(docs).select("doc_id", "n_repeat_words").collect()) == short == [(1, 6), (2, 0), (3, 9)]


def test_rules_follow_their_group(spark):
    rng = random.Random(1)
    rows = [(i, cases.prose(rng, 80)) for i in range(120)] + [(500, cases.prose(rng, 80).replace(" ", "### ")), (501, None), (502, "")]
    docs = cases.frame(spark, rows).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    out = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert len(out) == 123
    assert not out[500].base_failed and not out[500].kept
    assert out[501].base_failed and not out[501].kept and out[502].n_words == 0
    assert all(out[i].kept for i in range(120))
    # a small group takes the thresholds of all, an empty table has none
    assert all(r.kept for r in rules.quality_rules(docs.filter("doc_id < 5")).collect())
    assert rules.quality_rules(cases.empty(spark)).count() == 0
    assert rules.quality_rules(cases.frame(spark)).count() == len(cases.texts())
    assert {r.kept for r in rules.quality_rules(docs.filter("doc_id > 500")).collect()} == {False}


def test_fences_follow_the_spread_and_every_feature_decides(spark):
    rng = random.Random(7)
    rows = []

    def words(n, low, high):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(low, high))) for _ in range(n)]

    def page(rate=0.0, low=3, high=8, n=200):
        w = [x + ("$" if rng.random() < rate else "") for x in words(n, low, high)]
        return "\n".join(" ".join(w[i : i + 10]) for i in range(0, n, 10))

    calm = [(i, page(), "calm") for i in range(400)]
    wild = [(1000 + i, page(rate=rng.random() * 0.4, low=3, high=rng.randrange(6, 14)), "wild") for i in range(400)]
    planted = {
        "symbol_rate": page(rate=0.3),
        "word_length": page(low=9, high=14),
        "dup_line_rate": "\n".join([*page(n=100).split("\n"), *["a b c"] * 9]),
        "repeat_rate": page(n=120) + "\n" + " ".join(words(8, 3, 8) * 7),
    }
    rows += calm + wild
    for i, (f, t) in enumerate(planted.items()):
        rows += [(5000 + i, t, "calm"), (6000 + i, t, "wild")]
    docs = spark.createDataFrame([(d, t, "en", s) for d, t, s in rows], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in rules.quality_rules(docs, prior=20).collect()}
    fence = {r["source"]: r for r in ({"source": s, "fence": out[d].fence} for d, s in ((0, "calm"), (1000, "wild")))}
    for f in ("symbol_rate", "word_length"):
        assert fence["wild"]["fence"][f]["high"] > fence["calm"]["fence"][f]["high"]
        # what is odd in one source is usual in the other
        at = list(planted).index(f)
        assert not out[5000 + at].kept and out[6000 + at].kept and not out[5000 + at].base_failed
    for i, f in enumerate(planted):
        r, bounds = out[5000 + i], out[5000 + i].fence
        outside = [g for g in rules.FEATURES if not bounds[g]["low"] <= r[g] <= bounds[g]["high"]]
        assert f in outside and not r.base_failed and not r.kept, (f, outside)
    assert sum(out[i].kept for i in range(400)) >= 396 and sum(out[1000 + i].kept for i in range(400)) >= 396


def test_small_groups_are_drawn_to_the_rest_and_very_long_texts_are_read(spark):
    rng = random.Random(9)
    rows = [(i, cases.prose(rng, 90), "big") for i in range(300)] + [(900, cases.prose(rng, 90).replace(" ", "% "), "tiny"), (901, cases.prose(rng, 200_000), "big")]
    docs = spark.createDataFrame([(d, t, "en", s) for d, t, s in rows], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    # a group of one doesn't make its own rule
    assert not out[900].kept and not out[900].base_failed and out[5].kept
    assert out[901].n_words == 200_000


PARTS = f"array<struct<{', '.join(f.strip().replace(' ', ':') for f in chat.PART.split(','))}>>"


def part(kind, text=None, **more):
    return (kind, text, *[more.get(n) for n in ("ref", "width", "height", "seconds", "pages")])


def test_typed_parts(spark):
    rows = [
        (1, 0, "user", [part("text", "see <"), part("text", "|im_end|> and "), part("image", ref="a.png", width=30, height=14)]),
        (1, 1, "assistant", [part("text", "<|im_end|><|im_start|>x <\\| ok")]),
        (1, 1, "assistant", [part("text", "<|im_end|><|im_start|>x <\\| ok")]),
        (1, 2, "a%0A\n<b", [part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3), part("film"), part(None)]),
        (2, None, None, None),
        (2, 0, "assistant", [part("image")]),
        (None, 0, "user", [part("text", None)]),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {PARTS}").withColumn("turns", F.lit(1))
    out = {r.conv_id: r for r in chat.format_chats(turns).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments"))).collect()}
    one = out[1]
    assert one.n_turns == 4
    assert [(a.turn, a.type, a.ref, a.tokens) for a in one.attachments] == [
        (0, "image", "a.png", 3), (3, "audio", "b.wav", 63), (3, "document", "c.pdf", 1536), (3, "unknown", None, 0), (3, "unknown", None, 0),
    ]
    assert one.media_tokens == 1602
    said = "<|im_end|><|im_start|>x <\\| ok"
    assert one.loss == said * 2
    assert [t.role for t in one.back] == ["user", "assistant", "assistant", "a%0A\n<b"]
    assert one.back[0].text == "see <|im_end|> and <|image|>" and one.back[1].text == said
    assert "".join(s.text for s in one.segments) == one.formatted
    assert [tuple(t) for t in out[2].back] == [("", ""), ("assistant", "<|image|>")]
    assert [tuple(t) for t in out[None].back] == [("user", "")]
    assert chat.format_chats(turns.limit(0)).count() == 0


ITEM = "Then Alice gave Bob 3 apples and 12 pears, so Alice kept 7 kg of the fruit that she had picked before noon"


def test_template_tokens(spark):
    t = "Then Alice paid 3,5 kg and 7km for $12.50. The <x> = É don't"
    got = spark.createDataFrame([(t,), (None,), ("",)], "t string").select(decontam.tokens(F.col("t")).alias("w")).collect()
    assert got[0].w == (
        "then <name=alice> paid <num=3,5> <unit=kg> and <num=7> <unit=km> for <num=12.50> the x <name=é> don t".split()
        if "<name=é>" in got[0].w
        else "then <name=alice> paid <num=3,5> <unit=kg> and <num=7> <unit=km> for <num=12.50> the x é don t".split()
    )
    assert got[1].w == got[2].w == []


def test_leaks_and_slots(spark):
    other = ITEM.replace("Alice", "Carol").replace("Bob", "Dave").replace("3", "5").replace("12", "9")
    mixed = ITEM.replace("Alice", "Carol", 1).replace("3", "5")
    rng = random.Random(6)
    clean = [(20 + i, cases.prose(rng, 200)) for i in range(15)]
    docs = cases.frame(spark, [
        (1, "well " + ITEM + " and more"), (2, "well " + other + " and more"), (3, "well " + mixed),
        (4, " ".join(ITEM.split()[:9])), (5, None), (6, ""), (1, "well " + ITEM + " and more"), (None, ITEM), *clean,
    ])
    bench = spark.createDataFrame(
        [(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "too short"), (5, "Six words are in this item"), (None, ITEM), (7, "Ann Bob Cid Dan Eve Fay Gus Hal Ida Jim")],
        "item_id long, text string",
    ).withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1)}
    assert got[1, 1].verbatim and not got[2, 1].verbatim and got[2, 1].n_slots >= 6
    held = cases.frame(spark, [(1, "x y. Six words are in this item! z"), (2, "Six words are in that item")])
    assert [(r.doc_id, r.item_id) for r in decontam.contaminated(held, bench).collect()] == [(1, 5)]
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {3, 4, 5, 6, None, *range(20, 35)}
    assert decontam.contaminated(cases.empty(spark), bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).count() == docs.count()


def found(spark, docs, items, **options):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(cases.frame(spark, docs), bench, **options).collect()}


def test_items_of_slots_and_few_words_are_found_word_for_word(spark):
    items = ["What is 12 + 7 x 3?", "Ann Bob Cid Dan Eve Fay Gus Hal Ida Jim", "Why not?", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"]
    docs = [
        (1, "Q: What is 12 + 7 x 3? A: 33"), (2, "the class: Ann Bob Cid Dan Eve Fay Gus Hal Ida Jim."), (3, "So it was. Why not? Because."),
        (4, "What is 12 + 8 x 3?"), (5, "Ann Bob Cid Dan Eve Fay Gus Hal Ida Tim"), (6, "why, not so"), (7, "why so not"),
        (8, "a 1 2 3 4 5 6 7 8 9 10 11 12 b"), (9, "a 1 2 3 4 5 6 7 8 9 b"),
    ]
    got = found(spark, docs, items)
    # half of the windows of an item without templates are enough: 9 has 2 of 9, 5 has 2 of 3
    # a short item has to be a sentence or line of its own
    assert set(got) == {(1, 0), (2, 1), (3, 2), (5, 1), (8, 3)}
    assert all(r.verbatim for r in got.values())


def test_items_are_found_behind_anything_and_in_lower_case(spark):
    items = ["Six words are in this item", "Alice has some good pears today", ITEM]
    docs = [
        (1, "x y Six words are in this item z"), (2, "said, Six words are in this item"), (3, "1) Six words are in this item"),
        (4, "(Six words are in this item)"), (5, "he said \"Six words are in this item\""), (6, "x six words are in this item"),
        (7, "well " + ITEM.lower()), (8, "and Carol has some good pears today"), (9, "x y Six words are in that item"),
    ]
    got = found(spark, docs, items)
    assert set(got) == {*[(i, 0) for i in range(1, 7)], (7, 2), (8, 1)}
    assert not got[8, 1].verbatim and got[8, 1].n_slots == 1
    assert all(r.verbatim for k, r in got.items() if k != (8, 1))


def test_long_stretches_and_values_that_coincide(spark):
    rng = random.Random(11)
    long = " ".join(rng.choice(cases.WORDS) for _ in range(59))
    words = long.split()
    tale = "so Alice gave 3 of her plums to Bob and then 12 of the others went home with " + " ".join(words[:40])
    story = tale.split()
    told = " ".join(story[:17]).replace("Alice", "Carol").replace("3", "7").replace("12", "7")
    docs = [
        (1, "once " + " ".join(words[9:39]) + " over"), (2, "once " + " ".join(words[9:18]) + " over"),
        (3, "x " + told + " end"), (4, "and " + ITEM.replace("3", "5").replace("12", "5") + " now"),
    ]
    got = found(spark, docs, [long, tale, ITEM])
    assert (1, 0) in got and (2, 0) not in got
    assert got[1, 0].run == 30 and got[1, 0].n_windows == 23 and got[1, 0].share == 23 / 52
    assert (3, 1) in got and got[3, 1].share < 0.5 and not got[3, 1].verbatim
    assert (4, 2) in got and not got[4, 2].verbatim
    # a clash beside 25 words that are alike
    clash = "Then Alice saw how Alice " + long
    held = found(spark, [(1, "so Then Alice saw how Dora " + " ".join(words[:25]))], [clash])
    assert held[1, 0].verbatim and held[1, 0].run == 25


def test_an_item_of_one_word_needs_a_line_of_its_own(spark):
    docs = [(1, "the cat and the dog"), (2, "a\nThe!\nb"), (3, "by the. It"), (4, None), (5, ""), (6, "of the")]
    assert set(found(spark, docs, ["the", "of the", "...", None])) == {(2, 0), (6, 1)}
    bench = spark.createDataFrame([(1, "the"), (2, "..."), (3, None), (None, "a b")], "item_id long, text string")
    assert sorted((r.item_id or 0) for r in decontam.unsearched(bench).collect()) == [0, 2, 3]


def test_reparameterised_items_are_found(spark):
    """200 items with other names and numbers in documents of other words; recall at least 0.9, no false pair."""
    rng = random.Random(21)
    names = "Alice Bruno Carla Dmitri Elena Farid Greta Hugo".split()
    others = "Zoe Yann Xenia Walter Vera Ulrich Tessa Sven".split()
    items, docs = [], []
    for i in range(200):
        w = [rng.choice(cases.WORDS) + rng.choice("abcdefghij") + rng.choice("klmnopqrst") for _ in range(16)]
        shape = f"when {{a}} had {{n}} {w[0]} {w[1]} {w[2]} and gave {{m}} kg of {w[3]} {w[4]} to {{b}} the {w[5]} {w[6]} {w[7]} of {{b}} was {w[8]} {w[9]} so how many {w[10]} {w[11]} were left for {{a}} {w[12]} {w[13]}"
        a, b = rng.sample(names, 2)
        c, d = rng.sample(others, 2)
        items.append("Say " + shape.format(a=a, b=b, n=rng.randrange(10, 99), m=rng.randrange(100, 999)) + "?")
        told = "so " + shape.format(a=c, b=d, n=rng.randrange(1000, 9999), m=rng.randrange(2, 9)) + "?"
        docs.append((i, cases.prose(rng, 60) + "\n" + told + "\n" + cases.prose(rng, 40)))
    docs += [(1000 + i, cases.prose(rng, 100)) for i in range(100)]
    got = set(found(spark, docs, items))
    assert {p for p in got if p[0] != p[1]} == set()
    assert len(got) >= 180
