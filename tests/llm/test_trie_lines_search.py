"""Prefix trie, line dedup and lexical search: brute force on small tables, nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from touchline.llm import lexical_search, line_dedup, prefix_trie, queries
from touchline.llm.common import hot_join

CLASHING = "key line id item term m n docs rank score block position ka kb depth _share _hot n_docs words slot".split()


def clashing(frame):
    return frame.select("*", *(F.lit("x").alias(c) for c in CLASHING))


# --- prefix trie ------------------------------------------------------------

def brute_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(turns)] for c, turns in given.items()}
    full = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        full[c] = given.get(base, [])[:h] + own[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        path = tuple(turns)
        ends[path].append(c)
        for d in range(len(turns) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += (len(convs) - 1) * words
    sha = lambda convs: hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest()
    return sorted((min(c), len(p), min(members[p[:-1]]) if p else None, len(c), len(children.get(p, ())), leaves[p], saved[p], sha(ends.get(p, [])))
                  for p, c in members.items())


def spark_trie(frame):
    nodes, ends = prefix_trie.prefix_trie(frame)
    rows = nodes.join(prefix_trie.ends_digest(ends), prefix_trie.KEY, "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return sorted((r["conv_id"], r["depth"], r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"] or empty)
                  for r in rows)


def conversations():
    rng = random.Random(5)
    shared = [("user" if i % 2 == 0 else "assistant", f"turn {i} of a long talk") for i in range(70)]
    rows = []
    for c in [*range(-45, 60), 400, 401, 10**12]:
        if c in (0, 20):
            continue  # groups without a base
        kind = rng.randrange(5)
        if kind == 0:  # a long common opening, cut anywhere, with an end of its own
            own = shared[:rng.randrange(1, 70)] + [("user", f"end {rng.randrange(6)}")] * rng.randrange(3)
        elif kind == 1:
            own = [("user", "hello there\tyou")] * rng.randrange(1, 30)
        else:
            own = [(rng.choice(("user", "assistant", None)), rng.choice(("", None, "a b", "a  b c", "É ß"))) for _ in range(rng.randrange(1, 9))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(own)]
    rows += [(5, None, "user", "no turn"), (5, None, None, None), (7, 0, "user", "tie"), (7, 0, "assistant", "tie"), (7, 0, "user", "tie"),
             (None, 0, "user", "no conversation"), (441, 0, "user", "alone"), (442, 0, "user", "a " * 40_000)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_equals_brute_force(spark):
    rows = conversations()
    frame = clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))
    expected = brute_trie(rows)
    assert any(n[1] > 3 * prefix_trie.BLOCK for n in expected)  # several blocks
    assert spark_trie(frame) == expected
    assert any(e[1] == 0 for e in expected)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(alone, 0, "user", "x"), (alone, 1, "user", "y")]
    assert spark_trie(spark.createDataFrame(rows, SCHEMA)) == brute_trie(rows) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_trie_of_nothing(spark):
    assert spark_trie(spark.createDataFrame([], SCHEMA)) == []
    assert spark_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_hot_join_loses_and_doubles_nothing(spark):
    large = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("k"), "id")
    small = large.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    small = small.where("k <> 11")
    found = {tuple(r) for r in hot_join(large, small, ["k"], "n", "id").select("k", "id", "top").collect()}
    assert found == {tuple(r) for r in large.join(small, "k", "left").select("k", "id", "top").collect()}
    assert hot_join(large, small.where("false"), ["k"], "n", "id").count() == 5000


# --- line dedup -------------------------------------------------------------

def test_lines_equal_brute_force(spark):
    rng = random.Random(2)
    common = [f"Line number {i} that many documents hold, or few ÉÜ" for i in range(12)] + ["short", "", "Straße " * 6, "x" * 39, "y" * 40]
    docs = []
    for d in range(60):
        parts = [rng.choice(common) if rng.random() < 0.6 else f"own line {rng.random()} of document {d} and nobody else" for _ in range(rng.randrange(12))]
        docs.append((d, "\n".join(rng.choice(("", " ", "\t", "\r", "\x0b ")) + (p.upper() if rng.random() < 0.2 and p.isascii() else p) + rng.choice(("", "\r")) for p in parts)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join(common * 900)), (None, common[0]), (None, None), (30, docs[30][1]), (30, common[1])]
    white = " \t\n\x0b\x0c\r"
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(white))
    holders = defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and d is not None:
                holders[key(line)].add(d)
    expected = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < 5 or d == max(holders[key(x)])]
        expected.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    found = [tuple(r) for r in line_dedup.without_shared_lines(frame).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert sum(e[2] for e in expected) > 50
    assert line_dedup.without_shared_lines(frame.where("false")).count() == 0


# --- lexical search ---------------------------------------------------------

def brute_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = lambda t: term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(d, Counter(terms(t))) for d, t in docs if d is not None]
    bags = [(d, b, b.total()) for d, b in bags if b]
    n, total = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(Counter)
    for i, t in set(items):
        if i is not None:
            asked[i].update(terms(t))
    found = []
    for i, held in asked.items():
        scores = []
        for d, bag, size in bags:
            m = 25 + 75 * size * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t, q in held.items() if t in bag)
            if s:
                scores.append((-s, d))
        found += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


@pytest.fixture()
def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["É", "straße", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(d, rng.choice((" ", "-", "\n")).join(rng.choices(words, weights, k=rng.choice((1, 5, 5, 5, 40, 300))))) for d in range(400)]
    docs += [(500 + i, "tie tie other words") for i in range(30)]
    docs += [(600, None), (601, ""), (602, " .\n"), (None, "w1 w2"), (603, "W1 " * 30_000), (604, "w7" * 5_000), (500, "tie tie other words")]
    items = [(1, "w1 w2 W3, w250"), (2, None), (3, ""), (4, "absent"), (None, "w1"), (5, "tie"), (6, "É straße 日本 w4 w4"), (6, "É straße 日本 w4 w4"),
             (7, "w20"), (7, "w21"), (8, " ".join(words))]
    return docs, items


@pytest.mark.parametrize("k", [1, 10])
def test_search_equals_brute_force(spark, corpus, monkeypatch, k):
    monkeypatch.setattr(lexical_search, "QUESTION_TERMS", 3 if k == 1 else 200_000)  # many blocks of questions
    docs, items = corpus
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in lexical_search.rank(frame, asked, k).collect()) == brute_search(docs, items, k)


@pytest.mark.parametrize("limits", [{}, {"postings": 50, "documents": 7}])
def test_stored_index_answers_later_questions(spark, corpus, tmp_path, limits):
    docs, items = corpus
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = lexical_search.build_index(frame, str(tmp_path / "index"), **limits)
    for part in (items[:5], items[5:]):
        asked = spark.createDataFrame(part, "item_id long, text string")
        assert sorted(tuple(r) for r in lexical_search.search(index, asked).collect()) == brute_search(docs, part, 10)
    blocks = index.blocks.select("m", "docs").collect()
    assert (len(blocks) > 2 * len({b["m"] for b in blocks})) == bool(limits)
    assert sorted(d for b in blocks for d in b["docs"]) == sorted(d for d, t in docs if d is not None and lexical_search.term_counts((t or "").encode()))


def test_search_of_nothing(spark, corpus):
    docs, items = (spark.createDataFrame(r, s) for r, s in zip(corpus, ("doc_id long, text string", "item_id long, text string")))
    assert lexical_search.rank(docs.where("false"), items).count() == 0
    assert lexical_search.rank(docs, items.where("false")).count() == 0


def test_parts_of_a_long_text_are_cut_between_terms(monkeypatch):
    text = ("Ab é-" * 400 + "x" * 300).encode()
    whole = lexical_search.term_counts(text)
    monkeypatch.setattr(lexical_search, "PART", 7)
    assert lexical_search.term_counts(text) == whole and whole[b"ab"] == 400


def test_registered(spark):
    assert {"op11_prefix_trie", "op12_line_dedup", "op13_lexical_search"} <= set(queries.ORACLES)
