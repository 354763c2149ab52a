import json
import random

from sixfold.operators import documents as docs


ROOT = ("", "", "session_info", 0)
# Each document with its nodes, written out by hand.
DOCUMENTS = [
    (
        {"a": 1, "b": {"c": "x" * 40, "d": [1, 2, 3, 4, 5, 6, 7], "e": None, "f": True}, "g": [], "h": {}},
        {
            ROOT,
            ("a", "", "a: 1", 1),
            ("b", "", "b", 1),
            ("b/c", "b", "c: xxxxxxxxxxxxxxxxxxxxxxxxx", 1),
            ("b/d", "b", "d", 1),
            ("b/d[0]", "b/d", "[0]", 1),
            ("b/d[1]", "b/d", "[1]", 1),
            ("b/d[2]", "b/d", "[2]", 1),
            ("b/d[3]", "b/d", "[3]", 1),
            ("b/d[4]", "b/d", "[4]", 1),
            ("b/e", "b", "e: None", 1),
            ("b/f", "b", "f: True", 1),
            ("g", "", "g", 1),
            ("h", "", "h", 1),
        },
    ),
    ([1, {"k": False}], {ROOT, ("[0]", "", "[0]", 1), ("[1]", "", "[1]", 1), ("[1]/k", "[1]", "k: False", 1)}),
    ({"t": "true", "n": "[1]", "z": 1.5}, {ROOT, ("t", "", "t: true", 1), ("n", "", "n: [1]", 1), ("z", "", "z: 1.5", 1)}),
]


def test_tree(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(DOCUMENTS)] + [(99, "{broken"), (98, None)], "doc_id int, payload string")
    rows = docs.flatten_tree(df).collect()
    for i, (_, nodes) in enumerate(DOCUMENTS):
        got = [(r.id, r.parent, r.label, r.value) for r in rows if r.doc_id == i]
        assert len(got) == len(set(got))
        assert set(got) == nodes
    assert not [r for r in rows if r.doc_id > 90]


def test_trees_of_all_depths(spark):
    # Objects k/k/.../k and arrays [0][0]...[0] with a scalar at the bottom, and quoted brackets that are no levels.
    rows = []
    for depth in (9, 30, 1000):
        rows += [(depth, '{"k":' * depth + "1" + "}" * depth), (-depth, "[" * depth + "1" + "]" * depth)]
    rows.append((0, r'{"a": "{[{[\\" , "b\\"{": 2}'.replace("\\\\", "\\")))
    df = spark.createDataFrame(rows, "doc_id int, payload string")
    got = docs.flatten_tree(df).collect()
    for depth in (9, 30, 1000):
        chain = {"/".join(["k"] * i) for i in range(depth + 1)}
        assert {r.id for r in got if r.doc_id == depth} == chain
        assert {r.id for r in got if r.doc_id == -depth} == {"[0]" * i for i in range(depth + 1)}
        assert [r.label for r in got if r.doc_id == depth and r.id.count("/") == depth - 1] == ["k: 1"]


def plain_tree(value, name="", parent="", label="root"):
    """The nodes of a parsed document, one call per node."""
    nested = isinstance(value, (dict, list))
    shown = "" if nested else str(value)
    out = [(name, parent, label if nested or label.startswith("[") or not name else f"{label}: {shown[:25]}", int(bool(name)))]
    if isinstance(value, dict):
        for k, v in value.items():
            out += plain_tree(v, f"{name}/{k}" if name else k, name, k)
    elif isinstance(value, list):
        for i, v in enumerate(value[:5]):
            out += plain_tree(v, f"{name}[{i}]", name, f"[{i}]")
    return out


def test_trees_against_a_plain_walk(spark):
    rng = random.Random(3)
    texts = ["", "x", 'quote " in', "back\\slash", "end\\", "tab\t", "{[", "]}", "\ue000", "\ue001", "\\\ue001\"", "a: b,", "ü" * 40, "x/y", "null"]

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.35:
            return {rng.choice(texts[1:]) + str(i): value(depth - 1) for i in range(rng.randint(0, 6))}
        if depth and kind < 0.6:
            return [value(depth - 1) for _ in range(rng.randint(0, 8))]
        return rng.choice([*texts, 1, -20, 12345678901, True, False, None])

    values = [value(6) for _ in range(150)] + [{f"k{i}": i for i in range(3000)}, {"a": [{"b": list(range(9))}] * 9}, {"s": "\\n\"" * 30_000}]
    rows = [(i, json.dumps(v, ensure_ascii=i % 2 == 0, indent=rng.choice([None, 2]))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "doc_id int, payload string")
    for levels in (0, 2, docs.LEVELS):
        got = {}
        for r in docs.flatten_tree(df, root="root", levels=levels).collect():
            got.setdefault(r.doc_id, []).append((r.id, r.parent, r.label, r.value))
        for i, v in enumerate(values):
            assert sorted(got[i]) == sorted(plain_tree(v)), rows[i][1][:300]


def test_paths_and_bad_values(spark):
    df = spark.createDataFrame([(1, '{"Lap": 12, "a": {"b": [5, 6]}}'), (2, '{"Lap": "twelve"}'), (3, "no json"), (4, None)], "doc_id int, payload string")
    got = docs.json_fields(df, {"lap": ("$.Lap", "double"), "six": ("$.a.b[1]", "int")}).orderBy("doc_id").collect()
    assert [(r.lap, r.six) for r in got] == [(12.0, 6), (None, None), (None, None), (None, None)]


def test_text_is_parsed_once(spark):
    df = spark.createDataFrame([(1, "{}")], "doc_id int, payload string")
    plan = docs.json_fields(df, {n: (f"$.{n}", "string") for n in "abcdef"})._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parsejson") <= 1 and plan.lower().count("parse_json") <= 1


def test_shred(spark):
    df = spark.createDataFrame([(1, '{"rows": [{"n": 1, "s": "x"}, {"n": 2}]}'), (2, '{"rows": []}'), (3, "{}")], "doc_id int, payload string")
    got = sorted(tuple(r) for r in docs.shred(df, "$.rows", "n int, s string").collect())
    assert got == [(1, 1, 1, "x"), (1, 2, 2, None)]


def message(doc_id, **fields):
    return (doc_id, "race_control_message", json.dumps(fields))


def test_feed(spark):
    rows = [
        message(1, Time="2024-01-01 10:00:30", Category="Flag", Flag="GREEN", Message="m" * 60, Lap=3),
        message(2, Time="2024-01-01 10:00:00", Category=None, Message="short"),
        message(3, Time="not a time", Category="Drs", Message="x"),
        message(4, Time="2023-01-01 10:00:00", Category="Drs", Message=None),
        message(5, Time="2024-01-01T10:00:00", Category="Flag", Message="y"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, doc_type string, payload string")
    got = {r.doc_id: r for r in docs.message_feed(df).collect()}
    # The earliest message counts even if it has no text; another form of time is no time.
    start = 365 * 86400
    assert set(got) == {1, 2, 3, 5}
    assert got[1].time_sec == start + 30 and got[2].time_sec == start and got[3].time_sec == 0.0 and got[5].time_sec == 0.0
    assert got[1].text_short == "m" * 50 + "..." and got[2].category == "Unknown" and got[2].flag == "" and got[2].lap == 0.0
    order = {r.category: r.y_pos for r in docs.timeline(docs.message_feed(df), hot_rows=1).collect()}
    assert order == {"Flag": 0, "Unknown": 1, "Drs": 2}


def test_flags(spark):
    df = spark.createDataFrame([("GREEN",), ("GREEN",), (None,)], "flag string")
    assert {r.flag: r.messages for r in docs.flag_summary(df).collect()} == {"GREEN": 2, None: 1}
