"""Operators with an exact definition, against brute force, with the awkward cases."""

import random
import re

from opinlake.llm import copies, leaks, standing

DOC = "doc_id long, text string, source string, key string"


def _docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_standing_lines(spark):
    r = random.Random(2)
    foot = ["Rights reserved!", "SHARE this - page", "공유하기"]
    rows = []
    for i in range(240):
        lines = [f"line {r.randint(0, 400)} text" for _ in range(r.randint(0, 5))] + [f"unique{chr(97 + i % 26)}{chr(97 + i // 26)}"]
        if r.random() < 0.3:
            lines += [r.choice([foot[0], foot[0].lower(), "  rights   RESERVED\r"]), "12", r.choice(foot[1:])]
        rows.append((i, "\n".join(lines), r.choice(["a", "a", "b", None]), "clash"))
    rows += [(1000, None, "a", None), (1001, "", "a", None), (1002, "x" * 200_000, "a", None)]
    key = lambda s: "".join(c for c in s if c.isalpha()).casefold()
    docs, total = {}, {}
    for i, t, s, _ in rows:
        total[s] = total.get(s, 0) + 1
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            docs.setdefault((s, k), set()).add(i)
    keep = {k for k, v in docs.items() if len(v) >= 3 and len(v) * 50 >= total[k[0]]}
    want = {(i, n) for i, t, s, _ in rows for n, x in enumerate((t or "").split("\n")) if (s, key(x)) in keep}
    df = _docs(spark, rows)
    got = [(x["doc_id"], x["line_no"]) for x in standing.find_standing(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    clean = {x["doc_id"]: x for x in standing.remove_standing(df).collect()}
    assert len(clean) == len(rows) and clean[1000]["clean_text"] is None and clean[1002]["n_removed"] == 0 and clean[0]["key"] == "clash"
    for i, t, _, _ in rows[:240]:
        assert clean[i]["clean_text"] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in want)
    assert standing.find_standing(df.limit(0)).count() == 0


def test_copies(spark):
    r = random.Random(4)
    rows = []
    for i in range(400):
        a, b = r.randint(1, 9), r.randint(1, 9)
        rows.append((i, r.choice([f"src-{a}_{b}", f"{b}/{a}/SRC", f"SRC {b}.{a}"]), r.choice(["Hello, world", "hello world!", "HELLOWORLD", "other", None, " "])))
    rows += [(900, None, "x"), (901, None, "x"), (902, "--", "x"), (903, "", None)]
    rows += [(1000 + i, "hot-1", "same") for i in range(60)]
    canon = lambda x: (tuple(sorted(re.findall(r"[^\W_]+", (x[1] or "").casefold()))), "".join(c for c in (x[2] or "") if c.isalnum()).casefold())
    groups: dict = {}
    for x in rows:
        if canon(x)[0]:
            groups.setdefault(canon(x), []).append(x[0])
    want = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    df = spark.createDataFrame(rows, "row_id long, id string, comment_text string")
    got = [(x["row_id_a"], x["row_id_b"]) for x in copies.pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    m = {x["row_id"]: (x["first_id"], x["n_copies"]) for x in copies.members(df).collect()}
    assert m == {k: (min(g), len(g)) for g in groups.values() if len(g) > 1 for k in g} and copies.members(df.limit(0)).count() == 0
    c = {x["row_id"]: x["n_copies"] for x in copies.collapse(df).collect()}
    assert sum(c.values()) == len(rows) and c[1000] == 60 and c[900] == c[901] == 1
    assert copies.pairs(df.limit(0)).count() == 0 and copies.collapse(df.limit(0)).count() == 0


def test_leaks(spark):
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["the", "of", "연금", "기금"]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, text(r.choice([5, 12, 20, 60]))) for i in range(60)]
    docs = []
    for i in range(300):
        w = text(r.randint(0, 200))
        if r.random() < 0.5:
            it = r.choice(items)[1]
            n = r.choice([8, 11, 12, 13, 30])
            a = r.randint(0, max(0, len(it) - n))
            p = r.randint(0, len(w))
            w[p:p] = it[a:a + n]
        docs.append((i, r.choice([" ", ", ", "\r\n", "_"]).join(x.upper() if r.random() < 0.3 else x for x in w)))
    docs += [(900, None), (901, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(99, None)], "item_id long, text string")
    runs = lambda w: {tuple(w[k:k + 12]) for k in range(len(w) - 11)}
    want = {(i, j) for i, x in docs for j, w in items if runs(leaks.words_of(x)) & runs(w)}
    got = [(x["doc_id"], x["item_id"]) for x in leaks.find_leaks(d, t).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert {(x["doc_id"], x["item_id"]) for x in leaks.find_leaks(d, t, max_index_words=60).collect()} == want
    assert leaks.find_leaks(d.limit(0), t).count() == 0 and leaks.find_leaks(d, t.limit(0)).count() == 0
