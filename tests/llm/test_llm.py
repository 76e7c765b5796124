"""Training-data operators against brute force, round trips and held-out accuracy, and on awkward tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from quillspark.llm import fingerprint, graph, hostrules, langid, mixing, neardup, packing, pii, quality, substring, toxicity
from quillspark.llm.common import pack, unpack
from quillspark.llm.queries import ORACLE, QUERIES

KINDS = "doc_id long, text string, lang string, source string, n_chars long, score double, slot int, h string, _t string, row string, component int"
LONG = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
AWKWARD = [
    (1, None, "en", "a"), (2, "", None, None), (3, "   \n\t ", "en", "a"), (4, "one", "fr", "b"), (5, "one two three", "fr", None),
    (6, LONG, "en", "a"), (7, LONG, "en", "a"), (7, LONG, "en", "a"), (8, "é" * 5000, None, "c"), (9, "9" * 3000, "de", "c"),
    (10, "a@b.co " * 30, "en", "a"), (11, "x\x00y \x01 z 中文   𝄞", "zh", "a"), (12, "?? ... !!", "en", "b"), (13, "<|endoftext|> it's, don't.", "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 1, "h", "t", "r", 3) for r in AWKWARD], KINDS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")


def words(text):
    return (text or "").encode().split()


def test_packed_arrays():
    a = [np.arange(5, dtype=np.uint32), np.zeros(0, np.int64), np.array([-1, 2**62], np.int64)]
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(a, unpack(pack(*a)), strict=True))


# ------------------------------------------------------------------------------------------------------- substring


def brute_substring(rows, window=13):
    first = {}
    for i, t in sorted(rows):
        w = words(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


def test_substring(docs, awkward):
    for df in (docs, awkward):
        want = brute_substring({(r.doc_id, r.text) for r in df.collect()})
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.substring_dedup(df).collect()}
        assert got == want


def test_substring_groups(docs, monkeypatch):
    """Frequent prefixes are extended; the result does not depend on it."""
    want = {r.doc_id: tuple(r) for r in substring.substring_dedup(docs).collect()}
    monkeypatch.setattr(substring, "GROUP", 50)
    _, frequent = substring.prefix_plan(docs)
    assert all(len(f) for f in frequent[:2])
    assert {r.doc_id: tuple(r) for r in substring.substring_dedup(docs).collect()} == want


def test_passages(docs):
    rows = substring.substring_dedup(docs, passages=True).collect()
    assert all(sum(p.end - p.start for p in r.passages) == r.n_removed for r in rows)


# ---------------------------------------------------------------------------------------------------- personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (16 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


HARD = ["a@b.com.x_y@c.d e@f", "1.2.3.4.5.6.7.8", "000.0.00012.255 256.1.1.1", "+1 (988) 555-2485", "+1((((", "a" * 50_000, "1." * 20_000, "x@" + "a." * 20_000 + "b", "é 4111 1111 1111 1111 ü 4111-1111-1111-1111 𝄞 a.b@c.de", "4111 1111 1111 1112"]


def test_personal_data(spark, docs, awkward):
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (hard, docs, awkward):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in pii.personal_data(df).collect():
            base = brute_base(texts[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in BASE]
            spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
            assert set(base) <= set(spans)
            assert spans == sorted(spans, key=lambda x: (list(BASE).index(x[0]), x[1], x[2]))


def test_candidates(spark):
    """Held-out sentences of the generator: what is private is found, what is not is left."""
    made = pii.examples(400, seed=99)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id long, text string")
    hit = total = false = 0
    for r in pii.personal_data(df).collect():
        text, private = made[r.doc_id]
        spans = [text[int(s) : int(e)] for _, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        total += len(private)
        hit += sum(any(p in s or s in p for s in spans) for p in private)
        false += sum(not any(p in s or s in p for p in private) for s in spans)
    assert hit / total > 0.9 and false / total < 0.05


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de now", 5), (2, None, 6), (3, "none", 7)], "doc_id long, text string, spans int")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "mail [EMAIL] now", 5), (2, None, 6), (3, "none", 7)]


def test_personal_data_is_native(docs):
    plan = pii.personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ------------------------------------------------------------------------------------------------------ classifiers


def test_language(spark):
    rows = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98


def test_language_awkward(docs, awkward):
    filters = langid.fit(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(awkward, filters).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 9, 12)) and got[4][0] != "und"
    none = langid.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(awkward, none).collect()} == {"und"}


def test_quality(spark):
    rows = QUERIES["op6_quality"](spark, "/root/testdata/sf0.1").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    assert sum(not r.predicted for r in bad) / len(bad) > 0.95
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.99


def test_quality_awkward(awkward, labels):
    model = quality.fit(awkward, labels, F.lit(True))
    assert all(0 <= r.score <= 1 for r in quality.score(awkward.select("doc_id", "text"), model).collect())
    assert quality.fit(awkward, labels.limit(0), F.lit(True)).scores(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0] > 0.99


def test_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    own = langid.fold(5)
    model = toxicity.fit(docs, marks.filter(own != 0))
    assert (np.diff(model.cuts) >= 0).all() and model.kept.sum() < 5_000
    rows = toxicity.severity(docs.select("doc_id", "text"), model).filter(own == 0).join(marks.withColumnRenamed("toxic", "y"), "doc_id").collect()
    bad, good = [r for r in rows if r.y], [r for r in rows if not r.y]
    assert sum(r.toxic for r in bad) / len(bad) > 0.85
    assert sum(r.toxic for r in good) / len(good) < 0.02
    assert all(abs(r.expected_severity) <= 3 and r.expected_severity >= r.score - 1e-9 for r in rows)


def test_toxicity_awkward(awkward, labels):
    model = toxicity.fit(awkward, labels)
    assert toxicity.severity(awkward.select("doc_id", "text"), model).count() == len(AWKWARD)


# ----------------------------------------------------------------------------------------------------- fingerprints


def test_edited_texts(docs, awkward):
    for df in (docs, awkward):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: r[0])
        got = fingerprint.edited_fingerprints(df).collect()
        assert len(got) == len(rows)
        want = defaultdict(list)
        for k, (i, t) in enumerate(rows):
            following, half = rows[(k + 1) % len(rows)][1], len(t) // 2
            want[i].append((len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()))
        have = defaultdict(list)
        for r in got:
            have[r.doc_id].append((r.n_chars, r.edited_sha256))
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def prints(texts):
    return [x.tolist() for x in fingerprint.fingerprints(*fingerprint._code_points(texts))]


def test_fingerprints(docs):
    texts = [r.text for r in docs.collect() if len(r.text) > 600]
    own, moved = prints(texts), prints(["some other start. " + t for t in texts])
    assert prints(texts[::-1])[::-1] == own  # a text's fingerprint is its own
    near = [fingerprint.likeness(a, b) for a, b in zip(own, moved, strict=True)]
    assert np.median(near) > 0.85
    assert np.median([fingerprint.likeness(a, b) for a, b in zip(own, own[1:], strict=False)]) < 0.1
    half = [fingerprint.likeness(a, b) for a, b in zip(own, prints([t[: len(t) // 2] for t in texts]), strict=True)]
    assert 0.3 < np.median(half) < 0.7


# ------------------------------------------------------------------------------------------------------- near-dups


def brute_components(rows, k=4, percent=80):
    sets = {}
    for i, t in rows:
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t or "").encode().split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    both = Counter((min(a, b), max(a, b)) for ids in held.values() for n, a in enumerate(ids) for b in ids[:n])
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def chain(spark):
    """Copies of one text, each with a little more changed, so that a group is linked by neighbours only."""
    base = [f"t{i}" for i in range(200)]
    rows = []
    for g in range(40):
        for w in range(0, 4):
            base = [f"n{g}_{w}_{i}" if i in (g * 4 + w, (g * 7 + w) % 200) else x for i, x in enumerate(base)]
        rows.append((1000 - g, " ".join(base)))
    rows += [(2000 + j, "a b c d e f g h " + f"z{j // 3}") for j in range(30)] + [(5000, None), (5001, "one two"), (5002, "ONE two"), (5003, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates(spark, docs, awkward):
    for df in (docs, awkward, chain(spark)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k=4).collect()}
        assert got == brute_components({(r.doc_id, r.text) for r in df.collect()})


def test_components_of_stars(spark, monkeypatch):
    """Stars are found as they are, and more edges look again only at the components that they join: the driver plans no round for either."""
    monkeypatch.setattr(graph, "_large_star", None)
    label = graph.components(spark.createDataFrame([(1, 5), (7, 1), (2, 9), (4, 4), (3, 8), (3, 8), (20, 21)], "a long, b long"))
    stars = {1: 1, 5: 1, 7: 1, 2: 2, 9: 2, 3: 3, 8: 3, 20: 20, 21: 20}
    assert sorted(map(tuple, label.collect())) == sorted(stars.items())
    more = spark.createDataFrame([(5, 9), (7, 8), (30, 31), (0, 21), (1, 7)], "a long, b long")
    after = stars | {2: 1, 9: 1, 3: 1, 8: 1, 30: 30, 31: 30, 0: 0, 20: 0, 21: 0}
    assert sorted(map(tuple, graph.linked(label, more).collect())) == sorted(after.items())


def test_components_of_chains(spark):
    """Long chains, a hub and edges among components, by the least node that is reached one by one."""
    random = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(100, 130)] + [(int(x), int(y)) for x, y in random.integers(200, 280, (50, 2))] + [(400, i) for i in range(300, 320)]
    more = [(int(x), int(y)) for x, y in random.integers(90, 420, (12, 2))]

    def reached(edges):
        least = {n: n for e in edges if e[0] != e[1] for n in e}
        for _ in least:
            for a, b in edges:
                if a != b:
                    least[a] = least[b] = min(least[a], least[b])
        return sorted(least.items())

    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    label = graph.components(frame(edges))
    assert sorted(map(tuple, label.collect())) == reached(edges)
    assert sorted(map(tuple, graph.linked(label, frame(more)).collect())) == reached(edges + more)


def test_blocks(spark, monkeypatch):
    """Buckets larger than a block give the same components."""
    df = chain(spark)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k=4).collect()}
    assert got == brute_components({(r.doc_id, r.text) for r in df.collect()})


def test_sketches():
    random = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        common = random.integers(0, 2**63, 800).astype(np.uint64)
        extra = random.integers(0, 2**63, int(800 / share - 800)).astype(np.uint64)
        a, b = np.sort(common), np.sort(np.concatenate([common, extra]))
        s = neardup.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert abs(neardup.estimates(s[:1], s[1:])[0] - share) < 0.15


# --------------------------------------------------------------------------------------------------------- packing


def test_packing(docs, awkward):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    for df in (docs, awkward):
        want = Counter(tuple(model.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in df.collect())
        rows = packing.pack_examples(df).collect()
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length
            by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
            by_sequence[r.sequence_id].append((r.offset, r.length))
        if df is docs:
            got = Counter()
            for parts in by_doc.values():
                parts.sort(key=lambda p: p[0])
                assert [p[0] for p in parts] == [sum(len(q[1]) for q in parts[:i]) for i in range(len(parts))]
                got[tuple(x for p in parts for x in p[1])] += 1
            assert got == want
        assert sum(r.length for r in rows) == sum(len(k) * n for k, n in want.items())
        padding = 0
        for parts in by_sequence.values():
            parts.sort()
            assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
            n = sum(p[1] for p in parts)
            assert n <= 4096
            padding += 0 if n & (n - 1) == 0 else 4096 - n
        assert padding <= 0.01 * sum(r.length for r in rows)


def test_packing_limits():
    """Three limits at once, and nothing lost."""
    random = np.random.default_rng(3)
    p = packing.Packer(100, 5, 40, 0)
    total = 0
    for i in range(300):
        n = int(random.integers(1, 260))
        total += n
        p.add(i, np.arange(n, dtype=np.uint32), int(n * random.random()))
    p.finish()
    assert sum(r[2] for r in p.rows) == total
    by = defaultdict(list)
    for r in p.rows:
        by[r[5]].append(r)
    assert all(sum(r[2] for r in rows) <= 100 for rows in by.values())


# ------------------------------------------------------------------------------------------------------ host rules


def test_host_rules(spark, duck):
    got = QUERIES["op8_host_rules"](spark, SF).toPandas()
    want = duck.execute(ORACLE["op8_host_rules"]).df()[list(got.columns)]
    assert got.sort_values("doc_id").values.tolist() == want.sort_values("doc_id").values.tolist()


def test_host_rules_awkward(awkward):
    rows = hostrules.host_rules(awkward).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        text = next(t for i, t, *_ in AWKWARD if i == r.doc_id) or ""
        w = text.encode().split()
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(cover), len(lines) - len(set(lines)))


def test_bad_host_goes(spark):
    rows = [(i, "short", "bad") for i in range(50)] + [(99, " ".join(f"w{i}" for i in range(40)), "bad")] + [(100 + i, " ".join(f"w{j}x{i}" for j in range(40)), "good") for i in range(50)]
    kept = {r.doc_id: r.kept for r in hostrules.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not kept[99] and all(kept[100 + i] for i in range(50))


def test_host_rules_are_native(docs):
    plan = hostrules.measures(docs, "source", ("doc_id",))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ---------------------------------------------------------------------------------------------------------- mixing


def test_pfair_deviation():
    random = np.random.default_rng(4)
    for _ in range(60):
        share = mixing.shares({f"s{i}": float(random.random()) + 0.01 for i in range(int(random.integers(1, 12)))}, 500)
        assert sum(share.values()) == 500
        slots = mixing.one_period(share, 500)
        assert sorted(x for s in slots.values() for x in s) == list(range(500))
        for s, a in share.items():
            for k, t in enumerate(slots[s]):
                assert k * 500 // a <= t < -(-(k + 1) * 500 // a)  # between release and deadline


def test_mixing(docs, awkward):
    for df in (docs, awkward):
        names = mixing.added(df.columns)
        rows = mixing.mix_sources(df, block=4).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in df.collect())
        if df is docs:
            by = defaultdict(set)
            for r in rows:
                by[r[names[1]]].add((r.source, r[names[0]]))
            assert all(len(v) == 1 for v in by.values())
    assert "slot_" in mixing.mix_sources(awkward).columns


def test_mixing_weights(spark):
    rows = [(i, "a" if i < 300 else "b", "t") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    order = [r.source for r in mixing.mix_sources(df, {"a": 1.0, "b": 1.0}, block=1).orderBy("slot").collect()]
    assert len(order) == 400
    assert all(abs(order[:n].count("b") - n / 2) <= 1 for n in range(1, 200))
    assert order[200:] == ["a"] * 200


@pytest.mark.parametrize("weights", [None, {"big": 1000.0, "s1": 2.0, "s2": 1.0}])
def test_mixing_many_sources(spark, weights):
    """More sources than the driver schedules one by one: every row has one place, a slot is a block of one source."""
    assert mixing.LARGE + 2 * mixing.FARTHEST + 1 <= mixing.SOURCES
    sizes = {"big": 900, **{f"s{i}": 1 + i % 7 for i in range(700)}}
    rows = [(s, t) for s, n in sizes.items() for t in range(n)]
    df = spark.createDataFrame([(i, s, f"t{t}") for i, (s, t) in enumerate([*rows, (None, 0)])], "doc_id long, source string, text string")
    out = mixing.mix_sources(df, weights, block=2).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(rows) + 1))
    by = defaultdict(list)
    for r in out:
        by[r.slot].append((r.source, r.block, r.place))
    assert sorted(by) == list(range(sum(-(-n // 2) for n in sizes.values()) + 1))
    assert all(len({x[:2] for x in v}) == 1 and sorted(x[2] for x in v) == list(range(len(v))) for v in by.values())
    if not weights:  # while all sources are live, the large one keeps to its share within a block
        order = [by[t][0][0] for t in sorted(by)]
        own = {s: n**mixing.TEMPER for s, n in [*sizes.items(), (None, 1)]}
        share = own["big"] / sum(own.values())
        assert all(abs(order[:t].count("big") - t * share) < 1.1 for t in range(1, 200))


# ------------------------------------------------------------------------------------------------- tables and pipeline


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline(spark):
    """Each stage against a plain check on its own input."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        before = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns
        ids = [r.doc_id for r in rows]
        if name == "quality classifier":
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 0}
            assert set(ids) <= set(before) and len(ids) == len(set(ids)) and len(bad & set(ids)) < 0.5 * len(bad)
        elif name == "near-duplicates":
            component = {i: c for i, (_, c) in brute_components({(r.doc_id, r.text) for r in before.values()}, k=5).items()}
            assert sorted(ids) == sorted(i for i, c in component.items() if i == c)
        elif name == "personal data":
            assert sorted(ids) == sorted(before) and all(not brute_base(r.text) for r in rows)
            assert all(r.text == before[r.doc_id].text for r in rows if not brute_base(before[r.doc_id].text) and "[" not in r.text)
        elif name == "mixing":
            assert sorted(ids) == sorted(before) and ids != sorted(ids)
        else:
            assert set(ids) == set(before)
        if name != "packing":
            docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_awkward(awkward, spark, tmp_path):
    import corpus_pipeline as P

    spark.createDataFrame([(4, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = awkward
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs = docs if name == "packing" else spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0


def test_pipeline_order(spark, monkeypatch):
    """Through run(), tables written and read again: from task to task the packed documents follow the schedule."""
    import corpus_pipeline as P

    before, seen = {}, []
    for key, value in {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "64m", "spark.sql.files.maxPartitionBytes": "64m"}.items():
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)  # a task for each file
    stages = [s for s in P.STAGES if s[0] in ("mixing", "packing")]
    monkeypatch.setattr(P, "STAGES", [stages[0], (stages[1][0], lambda s, d, f: seen.append(d) or stages[1][1](s, d, f))])
    try:
        rows = P.run(spark, "/root/testdata/sf0.01").select("doc_id", "sequence_id").collect()
        slot = {r.doc_id: r.slot for r in mixing.mix_sources(seen[0], mixing.TARGETS).select("doc_id", "slot").collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    by = defaultdict(set)
    for r in rows:
        by[r.sequence_id >> 32].add(slot[r.doc_id])
    spans = [(min(by[k]), max(by[k])) for k in sorted(by)]
    assert set(slot) == {r.doc_id for r in rows} and len(spans) > 2
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
