"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import io
import random

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from touchline.llm import (chat, components, decontaminate, embedding_dedup, packing, pii, quality, simhash, suffix_dedup,
                           urls, warc)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (None, "no id at all here"),
        (4, LONG), (5, LONG + " end"), (6, "one two three four five six"), (7, " \n\t "), (8, "É é A a ß")]


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with columns named like those that operators make."""
    clashing = "id key fingerprint score part hash start end length predicted n_words rank _rank".split()
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    return frame.select("*", *(F.lit("x").alias(c) for c in clashing))


def test_simhash(spark, docs):
    found = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert len(found) == len(ROWS)
    zero = {(i, c) for i, f, c in found if f == 0}
    assert {(2, 2), (3, 2), (7, 2)} <= zero
    assert {(i, c) for i, f, c in found if i in (1, 6)} == {(1, 1), (6, 1)}
    assert {c for i, f, c in found if i in (4, 5)} == {4}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(None) == 1 and 6 not in ids and 5 not in ids
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.one_of_each(docs.where("false")).count() == 0


def test_pigeonhole_loses_no_pair(spark):
    rng = random.Random(3)
    hubs = [rng.getrandbits(64) for _ in range(6)]
    values = {0, 2**64 - 1} | {h ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 5))) for h in hubs for _ in range(40)}
    values = sorted(values)
    frame = spark.createDataFrame([(i, v - 2**64 if v >= 2**63 else v) for i, v in enumerate(values)], "id long, fingerprint long")
    for radius in (0, 1, 3, 4, 6):
        met = {tuple(sorted((r["a"], r["b"]))) for r in simhash.near_pairs(frame, radius).collect()}
        assert met == {(i, j) for j in range(len(values)) for i in range(j) if 0 < (values[i] ^ values[j]).bit_count() <= radius}


def test_allocation_is_the_cheapest():
    costs = [[0, 5, 9, 20], [0, 1, 2, 3], [0, 4, 4.5, 30]]
    best = min(sum(c[t + 1] for c, t in zip(costs, ts)) for ts in
               ((a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)) if sum(ts) == 1)
    cost, chosen = simhash.allocate(costs, 1)
    assert cost == best and sum(chosen) == 1


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 200)] + [(500, 300), (300, 500), (7, 7), (None, 3), (1000, 999)]
    links += [(2000, 2001 + i) for i in range(500)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(7), "a", "b").collect()}
    assert found == {i: 1 for i in range(1, 201)} | {300: 300, 500: 300, 999: 999, 1000: 999} | {2000 + i: 2000 for i in range(501)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "ONE two three"), (2, None), (3, ""), (None, "four five"), (20, LONG[:400]), (20, LONG[:400])],
                                  "item_id long, text string")
    found = [r for r in decontaminate.report(docs, items).collect()]
    assert len(found) == len(ROWS)
    by = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found}
    assert by[1] == by[6] == (6, 5, ["1"], True)
    assert by[2] == by[3] == by[7] == (0, 0, [], False)
    assert by[4][2] == ["20"] and by[8][0] == 5
    assert {r["doc_id"] for r in decontaminate.clean(docs, items).collect()}.isdisjoint({1, 6})
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.report(docs.where("false"), items).count() == 0
    assert not decontaminate.report(docs, items.where("false")).where("n_hit > 0").count()


def test_different_words_stay_different(spark):
    texts = ["é É", "Ã ã", "à À", "日 本", "ß ẞ", "ü Ü", "İ i", "\u212a k", "a\u0301 á"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", decontaminate.words(F.col("t")).alias("w"))
    for r in frame.collect():
        a, b = r["t"].split(" ")
        assert len(r["w"]) == 2 and (r["w"][0] == r["w"][1]) == (a == b)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    found = quality.classify(docs, weights).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.keep_good(docs, weights).columns == docs.columns
    assert quality.classify(docs.where("false"), weights).count() == 0
    none = quality.fit(docs, labels.where("false"))
    assert quality.keep_good(docs, none).count() == len(ROWS)


def test_features_do_not_depend_on_blocks():
    texts = [b"", b"a b a", "É!! é??".encode(), b"x " * 2000, b"Word, word"]
    weights = np.random.default_rng(0).standard_normal(quality.BUCKETS + 1)
    together = quality.scores(texts, weights)
    assert np.allclose(together, [quality.scores([t], weights)[0] for t in texts])


def test_pii(spark, docs):
    found = pii.pseudonymise(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in found) == sorted((i or 0, t or "") for i, t in ROWS)
    assert pii.without_pii(docs).columns == docs.columns and pii.without_pii(docs.where("false")).count() == 0
    values = ["4337166598464399", "+1 (988) 555-2485", "+1 (132) 555-1352", "70.123.182.155", "123-45-6789", "2024-02-29", "31/12/2000",
              "DE89370400440532013000", "a.b42@x9.example.com"]
    kept = ["1234567890123456", "300.1.1.1", "000-11-2222", "2023-02-30", "1.2.3.4.5", "v3.0", "GB82WEST12345698765432"]
    frame = spark.createDataFrame([(i, f"<{v}> and {v}.") for i, v in enumerate(values + kept)], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in pii.pseudonymise(frame).collect()}
    for i, v in enumerate(values + kept):
        first, second = texts[i][1:-1].split("> and ")
        assert first == second and (first != v) == (v in values)
        assert v[0].isalpha() or [c.isdigit() for c in first if c not in "0123456789"] == [c.isdigit() for c in v if c not in "0123456789"]
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(frame, key="another").collect()}
    assert all(other[i] != texts[i] for i in range(len(values)))


@pytest.mark.parametrize("form", ["digits", "phone", "ssn", "email", "ip", "card"])
def test_pseudonyms_are_permutations(spark, form):
    i = F.col("id")
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    value, of = {
        "digits": (pad(i, 4), lambda v: pii.permute_digits(v, "k", "t")),
        "phone": (F.concat(F.lit("+1 ("), pad(i % 1000, 3), F.lit(") 155-"), pad(F.floor(i / 1000), 4)), lambda v: pii.phone(v, "k")),
        "ssn": (F.concat_ws("-", pad(i % 665 + 1, 3), F.lit("07"), pad(F.floor(i / 665) + 1, 4)), lambda v: pii.ssn(v, "k")),
        "email": (F.concat(F.char(97 + i % 26), F.char(97 + F.floor(i / 26) % 26), F.floor(i / 676).cast("string"), F.lit("@x.org")), lambda v: pii.email(v, "k")),
        "ip": (F.concat_ws(".", F.lit("10"), (i % 256).cast("string"), F.floor(i / 256).cast("string"), F.lit("7")), lambda v: pii.ip(v, "k")),
        "card": (pad(i * 10 + 4 * 10**14, 15), None),
    }[form]
    if of is None:
        check = lambda d: F.concat(d, F.pmod(-pii.luhn_sum(F.concat(d, F.lit("0"))), F.lit(10)).cast("string"))
        value, of = check(value), lambda v: pii.card(v, "k")
    frame = spark.range(6760).select(value.alias("v")).select("v", of(F.col("v")).alias("p"))
    rows = frame.collect()
    assert len({r["p"] for r in rows}) == len(rows) == 6760 and None not in {r["p"] for r in rows}
    if form == "card":
        luhn = lambda s: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10
        assert not any(luhn(r["p"]) for r in rows) and all(len(r["p"]) == 16 for r in rows)


def test_packing(spark, docs):
    found = packing.pack(docs, TOKENIZER).collect()
    tokens = packing.WordTokenizer(TOKENIZER)
    whole = sum(len(tokens.encode([t or ""])[0]) // 4 + 1 for _, t in ROWS)
    assert sum(r["length"] for r in found) == whole
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert packing.pack(docs.where("false"), TOKENIZER).count() == 0
    ids = packing.pieces(docs.where("doc_id = 8"), TOKENIZER, with_ids=True).first()["ids"]
    assert ids[-1] == packing.END_ID


@pytest.mark.parametrize("seed", range(6))
def test_best_fit(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 1024): rng.randint(1, 400) for _ in range(rng.choice([1, 5, 80, 700]))}
    gaps, left = {}, dict.fromkeys(counts, 0)
    for length, rank, n, sequence, offset in packing.best_fit(counts):
        left[length] += n
        for i in range(n):
            gaps.setdefault(sequence + i, []).append((offset, length))
    assert left == counts
    for own in gaps.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 1024
    plain = []  # sequential best fit, longest first
    for length in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)[:3000]:
        fits = [g for g in plain if g >= length]
        if fits:
            plain.remove(min(fits))
            plain.append(min(fits) - length)
        else:
            plain.append(1024 - length)
    if sum(counts.values()) <= 3000:
        assert len(gaps) <= 1.03 * len(plain) + 1


def test_tokens_are_those_of_tokenizers():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(TOKENIZER)
    texts = ["", "  a b", "a \n b", "y ", "don't 's we's", "x <|endoftext|> y", "a\x1c b\x85 c", "É à ß × ÷\r\n", "日本語 ½ º", "\u3000 a"]
    found = packing.WordTokenizer(TOKENIZER).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_suffixes(spark, docs):
    rng = random.Random(1)
    texts = ["a" * 300, "a" * 120 + "b" + "a" * 200, "ab" * 100, "abab" * 40, "x" * 49, "x" * 50, "x" * 50, "é" * 60, "",
             "".join(rng.choice("ab") for _ in range(4000))]
    texts += [texts[-1][100:1000] + "zz" + texts[-1][2000:2100], "q" + "ab" * 30 + "q", LONG[:5000], "y" + LONG[1000:4000]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    earlier, want = set(), {}
    for i, text in enumerate(texts):
        data, own = text.encode(), set()
        covered = bytearray(len(data))
        for p in range(len(data) - 49):
            own.add(data[p:p + 50])
            if data[p:p + 50] in earlier:
                covered[p:p + 50] = b"\1" * 50
        earlier |= own
        want[i] = bytes(x for x, c in zip(data, covered) if not c)
    assert {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.without_repeats(frame).collect()} == want
    found = suffix_dedup.without_repeats(docs).collect()
    assert len(found) == len(ROWS)
    assert [len(r["removed"]) for r in found if r["doc_id"] in (1, 2, 3, 4, None)] == [0] * 6
    assert [r["n_bytes"] - sum(s["end"] - s["start"] for s in r["removed"]) for r in found if r["doc_id"] == 5][0] < 10
    assert suffix_dedup.without_repeats(docs.where("false")).count() == 0


def test_chat(spark):
    hard = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "a\\b \\h ###x## </turn>"), (1, 1, "assist:ant", "####"), (1, 2, "assistant", None), (1, 2, None, "\\"),
            (None, None, "assistant", "### User: \\t</tur"), (1, 3, "assistant", "é</turn></turn>\\c"), (2, 0, "assistant", ""),
            (3, 1, "assistant", hard), (3, 0, "user", hard), (3, 1, "assistant", hard), (4, None, "assistant", LONG), (4, 1, "user", "x\n### y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("rendered", F.lit(2))
    plain = "### user: a\\b\\h</turn>"
    read = {r["conv_id"]: r for r in chat.parse_conversations(chat.format_conversations(turns)).collect()}
    for conv in (1, 2, 3, 4, None):
        given = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in read[conv]["turns"]] == [g[2:] for g in given]
        spans = [read[conv]["formatted"][s["start"]:s["start"] + s["length"]] for s in read[conv]["loss_spans"]]
        bodies = [spark.createDataFrame([(s,)], "s string").select(chat.unescape(F.col("s"))).first()[0] for s in spans]
        assert bodies == [x for *_, r, x in given if r == "assistant"]
        assert read[conv]["formatted"].count("</turn>") == len(given)
    assert plain and chat.format_conversations(turns.where("false")).count() == 0


def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "HTTP://A.Example.NET"), (4, "x://É.Org/fr/?q"), (5, "http://net/a#b"), (5, "http://net/a#b"),
             (None, "http://example.net/en/x"), (7, "http://notexample.com/de/"), (8, "http://casino-win.example.org/" + "a/" * 20_000), (9, "")]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("score", F.lit(1))
    found = [tuple(r)[:5] for r in urls.judge(frame).collect()]
    assert len(found) == len(pages)
    by = {r[0]: r[1:] for r in found}
    assert by[1][:3] == by[2][:3] == by[9][:3] == ("", "", None) and by[1][3] == by[2][3]
    assert by[3] == ("a.example.net", "", None, by[3][3]) and by[4] == ("É.org", "/fr/", "org/fr/", "allow")
    assert by[5] == ("net", "/a", "net/", "block") and by[None][2:] == ("example.net/en/", "allow")
    assert by[7][2] is None and by[8][3] == "block"
    assert urls.judge(frame.where("false")).count() == 0
    assert urls.judge(frame, rules=[]).where("rule is not null").count() == 0


def test_url_model_on_hosts_it_has_not_seen():
    weights = urls.train(urls.LABELLED)
    bad, good = ["casino-online.example.org", "spam-mail.example.net", "free-pills.example.com"], ["thering.example.com", "www.history.example.net"]
    assert all(urls.score(h, "/en/7", weights) >= 0.5 for h in bad) and all(urls.score(h, "/en/7", weights) < 0.5 for h in good)
    assert urls.score("", "", urls.train([])) == 0.5


def test_warc(spark):
    big = "<p>é</p>" * 30_000
    pages = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
             (1, None, big), (None, "u", big), (7, "日", "z" * 100), (8, "v", "z" * 100)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    found = [tuple(r) for r in warc.round_trip(frame).select("page_id", "record_type", "refers_to", "payload_bytes", "payload").collect()]
    size, key = len(big.encode()), lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=key) == sorted([
        (3, "revisit", 1, size, None), (1, "response", None, size, big), (1, "response", None, size, big), (None, "response", None, size, big),
        (2, "response", None, 0, ""), (4, "response", None, 0, ""), (5, "response", None, 5, "short"), (6, "response", None, 5, "short"),
        (7, "response", None, 100, "z" * 100), (8, "revisit", 7, 100, None)], key=key)
    assert warc.round_trip(frame.where("false")).count() == 0


def test_broken_archives_are_refused():
    payload = b"x" * 500
    record = warc.encode(1, "u", payload, hashlib.sha256(payload).hexdigest())
    words = warc.train_dictionary([record + bytes([i]) * 300 + str(i).encode() * 900 for i in range(200)])
    assert words
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)).compress(record)
    head = np.array([warc.DICTIONARY_FRAME, len(words)], "<u4").tobytes() + words
    assert [r.payload for r in warc.read_archive(io.BytesIO(head + frame * 3))] == [payload] * 3
    packed = zstandard.ZstdCompressor().compress(words)
    head2 = np.array([warc.DICTIONARY_FRAME, len(packed)], "<u4").tobytes() + packed
    assert len(list(warc.read_archive(io.BytesIO(head2 + frame)))) == 1
    for broken in (head + frame[:-5], head[:-9], frame, head + frame[:20] + b"?" + frame[21:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(broken)))
    for bad in (record[:-1], record.replace(b"500", b"501"), record.replace(b"xx", b"xy", 1), record.replace(b"WARC-Date", b"Date"), b"no"):
        with pytest.raises(ValueError):
            warc.decode(bad)


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in base[i] * 3]) for i in range(5)] + [(200, rows[0][1]), (200, rows[0][1]), (201, rows[0][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] + [1.0] * 15), (304, [float("inf")] * 16),
             (305, [None] + [1.0] * 15), (None, rows[1][1]), (306, [1.0, 2.0]), (307, [2.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit(0)).withColumn("n", F.lit(0))
    found = embedding_dedup.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found}
    assert by[0] == (3, 0, True) and by[200] == by[201] == by[100] == (3, 0, False)
    assert by[1] == (1, 1, True) and by[101] == (1, 1, False) and by[306] == (1, 306, True) and by[307] == (1, 306, False)
    assert all(by[i] == (0, i, True) for i in range(300, 306)) and by[None][:2] == (0, None)
    assert embedding_dedup.near_duplicates(frame.where("false")).count() == 0
