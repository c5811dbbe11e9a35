"""The corpus operators against brute force on small fixtures, with edge cases in one table."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from oracle_compare import _rows, duck
from shardsmith.llm import decontaminate, language, line_dedup, mixing, ngram_join, pairs, pii, quality, queries, revisits, secrets, substring_dedup
from shardsmith.llm.common import WordHasher, shingle_hashes, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, pass string, state int"


def prose(rng, n, first=0):
    return " ".join(f"w{first + rng.randrange(400)}" for _ in range(n))


def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, and columns that clash with outputs."""
    rng = random.Random(3)
    base = prose(rng, 200)
    ws = base.split()
    near = [" ".join(ws[:k] + ["changed"] + ws[k + 1 :]) for k in (20, 80, 140)]
    texts = [base, base, *near, None, "", " \n\t ", "one two", "One  TWO", "Short Line\nshort line \nother", prose(rng, 30_000), "x" * 50_000, "é" * 300, "a\n\n\nb"]
    texts += [f"boiler plate line\n{prose(rng, 60, 1000 + 500 * i)}" for i in range(12)]
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "", "s1", "s1", "s1")[i % 5], 1, "k", "p", 7) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, base, "en", "s1", 1, "k", "p", 7), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_sets(rows):
    out = []
    for r in rows:
        w = words(r[1])
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute_components(rows):
    sets = brute_sets(rows)
    comp = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    ids = defaultdict(list)
    for c, r in zip(comp, rows):
        ids[c].append(r[0])
    low = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return Counter((r[0], len(s), low[c] if s else r[0]) for r, s, c in zip(rows, sets, comp))


def test_words_and_hashes():
    h = WordHasher()
    for t in ("Ab cD\x0bEF ", "", None, "é É", " a b ", "x" * 70_000 + " y"):
        assert len(h(t)) == len(words(t))
    assert list(h("AB zz")) == list(h("x ab ZZ"))[1:] and h("É")[0] != h("é")[0]
    assert len(set(shingle_hashes(h("a b c d e a b c d e")).tolist())) == 5


def test_ngram_join(spark, edge, none):
    got = ngram_join.jaccard_components(edge).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(edge_rows())
    assert ngram_join.jaccard_components(none).count() == 0


def test_ngram_join_chains_and_blocks(spark, monkeypatch):
    """Chains of near copies, more of them than one list is compared in."""
    monkeypatch.setattr(pairs, "LIST", 7)
    monkeypatch.setattr(ngram_join, "BUCKET_POSTINGS", 500)
    rng = random.Random(5)
    ws, rows = prose(rng, 120).split(), []
    for i in range(40):
        ws[rng.randrange(len(ws))] = f"new{i}"
        rows.append((i, " ".join(ws)))
    rows += [(100 + i, prose(rng, 25)) for i in range(10)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(rows)


def test_line_dedup(spark, edge, none):
    rows = edge_rows()
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").encode().lower() for x in (t or "").split("\n")]
    found = defaultdict(set)
    for r in rows:
        for k in keys(r[1]):
            if k:
                found[k].add((r[0], r[1]))
    for at_least in (2, 10):
        want = Counter()
        for r in rows:
            lines = (r[1] or "").split("\n")
            kept = [x for x, k in zip(lines, keys(r[1])) if not k or len(found[k]) < at_least]
            want[(r[0], None if r[1] is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
        got = line_dedup.drop_lines(edge, at_least)
        assert got.columns[:3] == edge.columns[:3]
        assert Counter(tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect()) == want
    first = line_dedup.drop_lines(spark.createDataFrame([(2, "a\nB\na"), (1, "b \nc")], "doc_id bigint, text string"), keep_first=True)
    assert {r.doc_id: r.text for r in first.collect()} == {1: "b \nc", 2: "a"}
    assert line_dedup.drop_lines(none).count() == 0


def test_substring_dedup(spark, edge, none):
    rng = random.Random(9)
    passage = prose(rng, 60, 5000)
    plain = {i: prose(rng, 150, 10_000 + 1000 * i) for i in range(6)}
    texts = {i: (plain[i] + " " + passage + " " + plain[i][::-1] if i < 3 else plain[i]) for i in plain}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in substring_dedup.drop_repeats(df).collect()}
    assert all(got[i].n_repeated > 0.5 * len(passage) for i in range(3)) and got[0].n_dropped == 0
    assert all(got[i].n_dropped == got[i].n_repeated > 0 for i in (1, 2))
    assert all(got[i].n_repeated == 0 and got[i].text == texts[i] for i in (3, 4, 5))
    for i in texts:
        data, out = texts[i].encode(), got[i]
        cut = b"".join(data[a:b] for a, b in zip([0, *[d["end"] for d in out.dropped or []]], [*[d["start"] for d in out.dropped or []], len(data)]))
        assert cut.decode() == out.text
    text = ("é" * 500 + "a" * 1000) * 3
    data = text.encode()
    ends = substring_dedup.chunk_ends(data)
    assert ends[-1] == len(data) and all(b - a <= 128 for a, b in zip([0, *ends], ends))
    assert "".join(data[a:b].decode() for a, b in zip([0, *ends], ends)) == text
    assert substring_dedup.drop_repeats(edge).count() == len(edge_rows()) and substring_dedup.drop_repeats(none).count() == 0


def test_quality(spark, edge, none):
    def base(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) for k in range(3) if three[tuple(w[i : i + 3])] > 1}
        seen, dup = set(), 0
        for x in (t or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit)

    for t in [r[1] for r in edge_rows()] + ["a b c a b c\nx #*\nx #*\n \n ", "a a a a"]:
        assert quality.base_counts(t) == base(t)
    out = quality.quality_rules(edge)
    assert out.count() == len(edge_rows()) and not out.filter("base_failed and kept").count()
    assert quality.quality_rules(none).count() == 0
    rng = random.Random(1)
    texts = [prose(rng, 120) for _ in range(80)] + [" ".join(f"☃{rng.randrange(9)}☄" for _ in range(120))]
    got = quality.quality_rules(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string"), min_group=20)
    assert [r.doc_id for r in got.filter("not kept").collect()] in ([80], [])
    encode, fallback = quality.load_vocabulary(quality.VOCABULARY, open(quality.VOCABULARY, "rb").read())
    assert quality.fertility("☃" * 50, encode, fallback)[2] > quality.fertility("hello world " * 9, encode, fallback)[2] == 0


def test_language(spark, none):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.op7_language_mixture(spark, SF001).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.9
    langs, table = language.train(docs)
    by = {r.lang: r.text for r in docs.filter("length(text) > 1500").collect()}
    assert set(language.infer(by["en"][:1500] + " " + by["de"][:1500], table)) >= {langs.index("en"), langs.index("de")}
    edge = spark.createDataFrame([(r[0], r[1]) for r in edge_rows()] + [(None, "123 ☃")], "doc_id bigint, text string")
    rows = language.predict(edge, langs, table).collect()
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.predict(edge, *language.train(none)).collect()} == {"und"}


def test_pii_base():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def brute(t):
        out = [(m.start(), 0, m.end(), "email") for m in email.finditer(t)]
        out += [(m.start(), 1, m.end(), "ip") for m in ip.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
        for m in card.finditer(t):
            d = [int(x) for x in re.sub("[ -]", "", m.group())]
            s = sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(d)))
            out += [(m.start(), 2, m.end(), "card")] if 12 <= len(d) <= 19 and s % 10 == 0 else []
        out += [(m.start(), 3, m.end(), "phone") for m in phone.finditer(t) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
        return [(s, e, k) for s, _, e, k in sorted(out)]

    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("ab@@..--++  ()0123459") for _ in range(rng.randrange(60)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("4111 1111 1111 1111 a@b.co 10.0.0.256 1.2.3.4.5.6.7.8")[0] == (0, 19, "card")
    assert pii.base_spans("a" * 200_000 + "9" * 200_000) == []


def test_pii_bootstrap(spark, edge, none):
    rng = random.Random(4)
    rows = [(i, f"{prose(rng, 30)} contact: user{i}@mail.example and {prose(rng, 5)}") for i in range(20)]
    rows += [(100 + i, f"{prose(rng, 30)} contact: AB-55{i}-77 then {prose(rng, 5)}") for i in range(4)]
    rows += [(200 + i, f"{prose(rng, 30)} version: 1234{i} then") for i in range(20)]
    got = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    text = dict(rows)
    for i in range(4):
        (span,) = got[100 + i].all_spans
        assert text[100 + i][span.start : span.end] == f"AB-55{i}-77" and span.kind == "id" and got[100 + i].n_added == 1
    assert not any(got[200 + i].all_spans for i in range(20))
    assert pii.personal_data(edge).count() == len(edge_rows()) and pii.personal_data(none).count() == 0


def test_decontamination(spark, edge, none):
    rng = random.Random(6)
    items = [(i, prose(rng, n, 20_000 + 1000 * i)) for i, n in enumerate((15, 24, 40, 59, 3))] + [(5, None), (6, "")]
    edit = lambda t: " ".join("changed" if i == len(t.split()) - 3 else w for i, w in enumerate(t.upper().split()))
    docs = [(i, f"{prose(rng, 200)} {t} {prose(rng, 90)}") for i, t in items[:5]] + [(10 + i, f"{prose(rng, 80)} {edit(items[i][1])} end") for i in (2, 3)] + [(20, prose(rng, 500)), (21, None), (22, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    found = {r.doc_id: {c.item: c for c in r.contamination} for r in got}
    assert all(found[i][i].similarity == 1 and found[i][i].start_word == 200 for i in range(5))
    assert set(found[12]) == {2} and set(found[13]) == {3} and not any(found[i] for i in (20, 21, 22))
    h = WordHasher()(prose(rng, 3000))
    for size, lo, prints in decontaminate.fingerprints(h, [5, 12]):
        bits = (h[lo : lo + size, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        assert int(prints[0]) == sum(1 << int(b) for b in np.flatnonzero(bits.sum(axis=0) > size // 2))
    a, b = np.random.default_rng(1).integers(0, 2**63, (2, 400)).astype(np.uint64)
    b[:50] = a[:50] ^ np.uint64(0b10000001)
    i, j = decontaminate.Blocks(b, 3).pairs(a)
    assert {(x, y) for x, y in zip(i.tolist(), j.tolist())} == {(x, y) for x in range(400) for y in range(400) if bin(int(a[x] ^ b[y])).count("1") <= 3}
    assert decontaminate.contamination(edge, bench).count() == len(edge_rows())
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(edge, bench.limit(0)).filter("size(contamination) > 0").count()


def test_mixing(spark, edge, none):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(5, 60)), "big" if i % 10 else f"s{i % 70 // 10}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    tokens = Counter()
    for _, t, s in rows:
        tokens[s] += len(t.split())
    total = sum(tokens.values())
    got = mixing.mix_sources(docs, target_entropy=0.9, block_tokens=300).collect()
    p = np.array([tokens[s] / total for s in sorted(tokens)])
    entropy = lambda a: -sum(w * np.log(w) for w in p**a / (p**a).sum())
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if entropy(mid) >= 0.9 * np.log(len(p)) else (lo, mid)
    used, times = Counter(), Counter()
    for r in got:
        used[r.source] += r.n_tokens
        times[(r.doc_id, r["pass"])] += 1
    quota = dict(zip(sorted(tokens), p**lo / (p**lo).sum() * total))
    assert max(times.values()) == 1 and all(quota[s] - 60 <= used[s] <= quota[s] + 1 for s in tokens)
    for s in tokens:  # passes before the last are whole
        passes = Counter(r["pass"] for r in got if r.source == s)
        assert all(passes[k] == sum(x[2] == s for x in rows) for k in range(max(passes)))
    once = mixing.mix_sources(docs, target_entropy=0.0).collect()
    assert Counter(r.doc_id for r in once) == Counter(r[0] for r in rows)
    table = spark.createDataFrame(sorted(tokens.items()), "__source string, tokens long")
    a = mixing.find_exponent(table, None, 2.0)
    assert (p ** (a - 1) / (p**a).sum()).max() <= 2.0001
    assert mixing.mix_sources(edge).columns[:2] == ["doc_id", "text"] and mixing.mix_sources(none).count() == 0


def test_revisits(spark):
    c = lambda u: spark.createDataFrame([(u,)], "u string").select(revisits.canonical_url(F.col("u"))).head()[0]
    assert c("HTTP://www.Ex.org:80/a/?b=2&utm_source=x&a=1#f") == c("https://ex.org/a?a=1&b=2") == "ex.org/a?a=1&b=2"
    assert c(None) is None and c("no url#x") == "no url"
    day = 86_400
    rows = [
        (1, "response", "http://a/x", 10, 200, {"ETag": '"1"', "Content-Type": "t", "Age": "1"}, "one"),
        (2, "response", "http://a/x/", 20, 404, {"ETag": '"9"'}, "bad"),
        (3, "revisit", "https://a/x#z", 10, 304, {"ETag": '"1"'}, None),
        (4, "revisit", "https://a/x#z", 11 + 3 * day, 304, {"etag": 'W/"1"', "Content-Type": "other", "AGE": "5"}, None),
        (5, "response", "http://a/x", 5 * day, 200, {"ETag": '"2"'}, ""),
        (6, "response", "http://a/x", 5 * day, 200, {"Last-Modified": "m"}, "six"),
        (7, "revisit", "http://a/x", 5 * day + 1, 304, {"last-modified": "m"}, None),
        (8, "revisit", "http://a/x", 5 * day + 1, 304, {"ETag": '"2"'}, None),
        (9, "revisit", "http://a/x", 4 * day, 304, {"ETag": '"7"'}, None),
        (10, "revisit", None, 4 * day, 304, None, None), (11, "revisit", "http://a/x", None, 304, None, None), (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "record_id bigint, record_type string, url string, time bigint, status int, headers map<string,string>, payload string").withColumn("outcome", F.lit(1))
    got = {r.record_id: r for r in revisits.resolve_revisits(df).collect()}
    assert {k: r.outcome for k, r in got.items()} == {1: "response", 2: "response", 3: "no_response", 4: "resolved", 5: "response", 6: "response", 7: "resolved", 8: "no_validator", 9: "mismatch", 10: "no_response", 11: "no_response", None: "response"}
    assert got[4].refers_to == 1 and got[4].payload == "one" and got[4].headers == {"etag": 'W/"1"', "content-type": "t", "age": "5"}
    assert got[7].payload == "six" and got[9].payload is None
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


def test_secrets(spark, edge, none):
    rng = random.Random(11)
    text = lambda i: f"{prose(rng, 20)} " + (f'token = "{rng.getrandbits(160):040x}"' if i % 2 else f"order {rng.randrange(10**15, 10**16)}") + f" {prose(rng, 20)}"
    rows = [(i, text(i), "src/a.py") for i in range(80)] + [(None, None, None), (90, "", ""), (91, "x" * 100_000, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = secrets.with_features(secrets.findings(docs), secrets.dictionary(docs)).cache()
    for r in found.collect():
        assert dict((a, b) for a, b, _ in rows)[r.doc_id][r.start : r.end] == r.value
    labelled = secrets.label_by_format(found)
    model = secrets.train(labelled.filter("doc_id < 50"))
    held = secrets.score(labelled.filter("doc_id >= 50"), model).collect()
    assert held and all(r.is_secret == bool(r.label) for r in held)
    assert secrets.train(labelled.filter("label = 1")) is None
    assert secrets.score(found, None).filter("is_secret").count() == found.count()
    want = Counter((r[0], v) for r in edge_rows() for v in re.findall(secrets.CANDIDATE, r[1] or ""))
    assert Counter((r.doc_id, r.value) for r in secrets.findings(edge).collect()) == want
    assert secrets.findings(none).count() == 0
    plan = secrets.score(found, model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark, edge):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bad, good = set(), docs
    for name, stage in P.STAGES[:-1]:
        good = P.materialize(stage(spark, good, SF001), name)
        assert good.columns == docs.columns
    mixed = P.run(spark, SF001)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= {r.doc_id for r in good.select("doc_id").collect()}
    out = edge
    for name, stage in P.STAGES:
        before, out = out, P.materialize(stage(spark, out, SF001), name)
        assert name == "mix_sources" or out.schema.names == edge.schema.names
    kept = P.one_of_each_group(spark, edge, SF001)
    want = brute_components(edge_rows())
    groups = {c for (_, n, c) in want if n}
    assert kept.count() == len(groups) + sum(k for (_, n, _), k in want.items() if not n)
    for name, stage in P.STAGES:
        assert stage(spark, edge.limit(0), SF001).count() == 0
