import random
from collections import defaultdict

from tunewright.llm import quotes as Q


def test_parse_levels_and_introductions():
    t = "Hi.\n\nOn Monday, Ann wrote:\n> First.\n> Second.\n>\n>> Older, wrote:\n>> deep words\n> > deep more\n\nMy answer.\n a > b"
    own, passages = Q.parse(t)
    assert own == "Hi.\n\nMy answer.\n a > b"
    assert passages == [(1, "First.\nSecond."), (2, "deep words\ndeep more")]
    assert Q.parse(None) == ("", []) and Q.parse("> only") == ("", [(1, "only")]) and Q.parse(">>>") == ("", [])


def test_units_ignore_wrapping_and_case():
    a = Q.units("One two three. Four\nfive six!\n\nSeven")
    b = Q.units("ONE two\nthree.")
    assert set(b) <= set(a) and list(b.values()) == [14]


def build(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, position string")


def test_links(spark):
    rows = [
        (1, 0, "u", "What is rain? I ask.", "x"),
        (1, 1, "a", "Water that falls. It is wet.", "x"),
        (1, 2, "u", "Unrelated.", "x"),
        (1, 3, "a", "A. wrote:\n> what is\n> rain?\nSee above.", "x"),
        (1, 4, "u", "> See above.\n>> What is rain? I ask.\n> nobody said this\nThanks.", "x"),
        (1, 5, "u", "> > Water that falls.\nno level one", "x"),
        (1, 6, "u", "> Later words.", "x"),
        (1, 7, "u", "Later words.", "x"),
        (2, 0, "u", "> What is rain?\nother conversation", "x"),
        (2, 3, "u", None, "x"),
        (None, 0, "u", "Null one.", "x"),
        (None, 1, "u", "> Null one.\nyes", "x"),
        (2, None, "u", "no turn", "x"),
    ]
    got = {(r.conv_id, r.turn): r for r in Q.link(build(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    say = lambda *k: (got[k].text, got[k].reply_to, got[k].by_quote, got[k].position)
    assert say(1, 0) == ("What is rain? I ask.", None, False, 0)
    assert say(1, 1) == ("Water that falls. It is wet.", 0, False, 1)
    assert say(1, 3) == ("See above.", 0, True, 3)
    assert say(1, 4) == ("Thanks.", 3, True, 4)
    assert [(q.level, q.source) for q in got[1, 4].quotes] == [(1, 3), (2, 0), (1, None)]
    assert say(1, 5) == ("no level one", 4, False, 5)
    assert got[1, 5].quotes[0].source == 1
    assert say(1, 6) == ("", 5, False, 6) and got[1, 6].quotes[0].source is None
    assert say(2, None)[3] == 0 and say(2, 0) == ("other conversation", None, False, 1)
    assert say(2, 3) == ("", 0, False, 2)
    assert say(None, 1) == ("yes", 0, True, 1)


def walk(parents):
    """Places of messages in reply order, by depth first search."""
    below = defaultdict(list)
    for i, p in enumerate(parents):
        below[p].append(i)
    place, todo = {}, [0]
    while todo:
        i = todo.pop()
        place[i] = len(place)
        todo.extend(reversed(below[i]))
    return place


def test_reply_order(spark):
    rows = [
        (1, 0, "u", "Root here.", ""),
        (1, 1, "u", "> Root here.\nFirst branch.", ""),
        (1, 2, "u", "> Root here.\nSecond branch.", ""),
        (1, 3, "u", "> First branch.\nDeep.", ""),
        (2, 0, "u", "Only one.", ""),
        (2, 1, "u", "Next.", ""),
    ]
    got = {(r.conv_id, r.turn): r.position for r in Q.link(build(spark, rows)).collect()}
    assert got == {(1, 0): 0, (1, 1): 1, (1, 2): 3, (1, 3): 2, (2, 0): 0, (2, 1): 1}


def test_names_that_the_operator_uses_itself(spark):
    rows = [(1, 0, "a", 5, 6, 7), (1, 1, "> a\nb", 8, 9, 10), (1, 1, "> a\nb", 8, 9, 10)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, _g long, c0 long, `x.y` long")
    got = Q.link(df).collect()
    assert sorted((r.position, r._g, r.c0, r["x.y"], r.by_quote) for r in got) == [
        (0, 5, 6, 7, False), (1, 8, 9, 10, True), (2, 8, 9, 10, True),
    ]


def test_one_message_with_all_answers_and_long_ways(spark):
    """Random trees against the depth first search: a hub, a chain, and mixtures."""
    rng = random.Random(2)
    trees = [[-1] + [0] * 300, [-1, 0, *range(1, 150), 0, 5], [-1]]
    trees += [[-1] + [rng.randrange(max(0, i - k), i) for i in range(1, n)] for k, n in ((2, 90), (9, 60), (99, 80))]
    rows, want, first = [], {}, 0
    for parents in trees:
        place = walk(parents)
        for i, p in enumerate(parents):
            rows.append((first + i, first, first + p if i else None))
            want[first + i] = place[i]
        first += len(parents)
    tree = spark.createDataFrame(rows, "_g long, _first long, _p long").repartition(5)
    got = Q.reply_order(tree).collect()
    assert len(got) == len(want) and {r._g: r.position for r in got} == want


def slow(rows):
    """Positions and answers by conversation, as defined."""
    groups = defaultdict(list)
    for conv, turn, text in rows:
        groups[conv].append((turn, text))
    out = {}
    for conv, items in groups.items():
        items.sort()
        first, parents = {}, []
        for i, (turn, text) in enumerate(items):
            own, passages = Q.parse(text)
            chars = defaultdict(int)
            for level, p in passages:
                for h, n in Q.units(p).items():
                    if level == 1 and h in first:
                        chars[first[h]] += n
            answer = max(chars, key=lambda k: (chars[k], k)) if chars else i - 1
            parents.append(answer)
            out[conv, turn] = (own, items[answer][0] if answer >= 0 else None, bool(chars))
            for h in Q.units(own):
                first.setdefault(h, i)
        place = walk(parents)
        for i, (turn, _) in enumerate(items):
            out[conv, turn] += (place[i],)
    return out


def test_random_conversations_and_a_hot_one(spark):
    rng = random.Random(4)
    rows = []
    for conv, n in [(0, 400), *[(c, rng.randrange(1, 9)) for c in range(1, 60)]]:
        said = []
        for turn in range(n):
            own = " ".join(f"{rng.choice('abcdef')}{rng.randrange(9)}." for _ in range(rng.randrange(1, 5)))
            text = own
            if said and rng.random() < 0.5:
                text = "> " + rng.choice(said).replace(" ", "\n> ") + f"\n>> {rng.choice(said)}\n" + own
            said.append(own)
            rows.append((conv, turn, text))
    df = build(spark, [(c, t, "u", x, "") for c, t, x in rows]).repartition(6)
    got = {(r.conv_id, r.turn): (r.text, r.reply_to, r.by_quote, r.position) for r in Q.link(df).collect()}
    assert got == slow(rows)


def test_repeated_rows_long_texts_and_empty_table(spark):
    rows = [(1, 0, "u", "same", "")] * 4 + [(1, 1, "u", "> " * 3000 + "x\n" + "w " * 200_000, "")]
    out = Q.link(build(spark, rows)).collect()
    assert sorted(r.position for r in out) == [0, 1, 2, 3, 4]
    assert Q.link(build(spark, rows).limit(0)).count() == 0


def test_query_keeps_texts_without_quotes(spark):
    d = "/root/testdata/sf0.01"
    want = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{d}/conversations.parquet").collect()}
    got = Q.op1_quotation_linking(spark, d).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.text == want[r.conv_id, r.turn].strip()
        assert r.position == r.turn and r.reply_to == (r.turn - 1 if r.turn else None)
