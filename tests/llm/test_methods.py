"""The methods behind the operators: brute force, exactness of weights, verdicts, texts' own fingerprints."""

import random
import string
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF
from quillspark.llm import fingerprint, hostrules, langid, mixing, packing, pii, quality
from quillspark.llm.common import Words
from quillspark.llm.queries import QUERIES

# --------------------------------------------------------------------------------------------------------- language


def plain_grams(text, size):
    """Runs of `size` bytes of the lower-cased text, each run of bytes that are no letters being one space."""
    raw = langid.lowered(np.frombuffer(text.encode(), np.uint8)).tobytes()
    out, last = bytearray(), True
    for b in raw:
        letter = 97 <= b <= 122 or b >= 128
        if letter or not last:
            out.append(b if letter else 32)
        last = not letter
    return [bytes(out[i : i + size]) for i in range(len(out) - size + 1)]


def test_many_languages(spark):
    """More languages than a mask has bits, each with as many rows as are learned: all are learned, and found again."""
    rng = random.Random(5)
    words = {f"l{i:02d}": ["".join(rng.choice(string.ascii_lowercase) for _ in range(7)) for _ in range(30)] for i in range(70)}
    rows = [(i * 100 + j, lang, " ".join(rng.choice(w) for _ in range(25))) for i, (lang, w) in enumerate(words.items()) for j in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    filters = langid.fit(docs, F.lit(True), per_language=6)
    assert filters.languages == sorted(words) and len(filters.tables) == 2
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, filters).collect()}
    assert sum(got[i] == lang for i, lang, _ in rows) / len(rows) > 0.99


def test_language_counts(spark):
    """Filters against sets: every n-gram of a language is in its filter, and counts differ by what chance lets through."""
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    by = defaultdict(list)
    for r in docs[:120]:
        by[r.lang].append(r.text)
    filters = langid.Filters({lang: langid.language_bits([t.encode() for t in texts]) for lang, texts in by.items()})
    held = {lang: {g for size in (langid.GRAM, langid.SHORT) for g, n in Counter(g for t in texts for g in set(plain_grams(t, size))).items() if n >= min(langid.LEAST, len(texts))} for lang, texts in by.items()}
    for r in docs[120:160]:
        raw = r.text.encode()
        share = filters.scores(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        grams = plain_grams(r.text, langid.GRAM)
        grams += plain_grams(r.text, langid.SHORT) if len(grams) < langid.FEW else []
        counts = np.array([sum(g in held[lang] for g in grams) for lang in filters.languages], float)
        assert np.abs(share - counts / max(1, counts.sum())).max() < 0.05


# ----------------------------------------------------------------------------------------------------- fingerprints


def plain_parse(names):
    """One level of locally consistent parsing of one text, name by name."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    return runs


def plain_fingerprint(text):
    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * int(fingerprint.MIX_A) & mask
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    golden, out, names, done = int(fingerprint.GOLDEN), set(), [ord(c) for c in text], False
    for level in range(1, fingerprint.FIRST + fingerprint.LEVELS):
        if names:
            runs = plain_parse(names)
            if level == 1:
                names = [x | (n - 1) << fingerprint.POINT_BITS for x, n in runs]
            else:
                names = [mix(x ^ (n * golden & mask)) if n > 1 else x for x, n in runs]
            label = []
            for i, x in enumerate(names):
                low = 0 if i == 0 else ((x ^ names[i - 1]) & -(x ^ names[i - 1])).bit_length() - 1
                label.append(2 * low + (x >> low & 1))
            for _ in range(2):
                low = [0] + [((a ^ b) & -(a ^ b)).bit_length() - 1 if a != b else 0 for a, b in zip(label[1:], label, strict=False)]
                label = [2 * k + (x >> k & 1) for k, x in zip(low, label, strict=True)]
            n = len(names)
            begin = [i for i in range(n) if i == 0 or 1 < i < n - 1 and label[i] > label[i - 1] and label[i] > label[i + 1]]
            names = []
            source = [x for x in _names(runs, level, mix, golden, mask)]
            for a, b in zip(begin, [*begin[1:], n], strict=True):
                value = (source[a] * golden + b - a) & mask
                for x in source[a + 1 : b]:
                    value = (value ^ x) * int(fingerprint.MIX_A) & mask
                    value ^= value >> 29
                names.append(mix(value))
        if level >= fingerprint.FIRST or (len(names) == 1 and not done):
            out |= {x >> 16 for x in names}
        done = done or len(names) == 1
    return sorted(out)[: fingerprint.SIZE]


def _names(runs, level, mix, golden, mask):
    return [x | (n - 1) << fingerprint.POINT_BITS for x, n in runs] if level == 1 else [mix(x ^ (n * golden & mask)) if n > 1 else x for x, n in runs]


def hard_texts():
    """Texts whose ends and starts are runs of one character, so that neighbours in a batch could touch."""
    rng = random.Random(3)
    out = ["", "a", "aa", "...", "..", ".", "a" * 5000, "...and so it went on, ...", "...and so on", "no more ...", "𝄞𝄞é", "ab" * 300]
    for _ in range(60):
        out.append("".join(rng.choice("ab.é ") * rng.choice([1, 1, 2, 3, 7]) for _ in range(rng.randint(0, 60))))
    return out


def test_fingerprint_is_the_texts_own():
    texts = hard_texts()
    alone = [fingerprint.fingerprints(*fingerprint._code_points([t]))[0].tolist() for t in texts]
    assert alone == [plain_fingerprint(t) for t in texts]
    rng = random.Random(4)
    for _ in range(20):  # any neighbours, any cut of the batch
        order = [rng.randrange(len(texts)) for _ in range(90)]
        cut = rng.randrange(1, 90)
        got = [x.tolist() for part in (order[:cut], order[cut:]) for x in fingerprint.fingerprints(*fingerprint._code_points([texts[i] for i in part]))]
        assert got == [alone[i] for i in order]


def test_edited_fingerprints(spark):
    """All columns against plain code; equal texts have equal fingerprints wherever they stand."""
    rows = list(enumerate(t for t in hard_texts() for _ in (0, 1)))
    random.Random(6).shuffle(rows)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    name = lambda names: "".join(f"{x:012x}" for x in names)
    for k, t in rows:
        following, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        own, edited, other = plain_fingerprint(t), plain_fingerprint(t[: len(t) - half] + following[:half]), plain_fingerprint(following)
        near = [1.0 if a == b else 0.0 if not a or not b else len(set(a) & set(b) & set(sorted(set(a) | set(b))[: fingerprint.SIZE])) / len(sorted(set(a) | set(b))[: fingerprint.SIZE]) for a, b in ((own, edited), (own, other))]
        assert (got[k].fingerprint, got[k].edited_fingerprint, got[k].near_edited, got[k].near_next) == (name(own), name(edited), *near)


# ------------------------------------------------------------------------------------------------------- host rules


def test_verdicts_count(spark):
    """On documents the hosts' verdicts decide beyond the base rules, and on labelled rows they agree with the labels."""
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_host_rules"](spark, folder).filter("not kept and not base_failed").collect()
    assert len(rows) > 20
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    marked = [quality[r.doc_id] for r in rows if r.doc_id in quality]
    assert marked.count(0) > 0.9 * len(marked)


def test_sign_counts_where_it_is_habit(spark):
    """The same page of symbols goes from a host that is full of them and stays where it is rare."""
    plain, page = " ".join(f"w{i}" for i in range(30)), " ".join(f"<w{i}>" for i in range(30))
    rows = [(i, page if i < 300 else plain, "junk") for i in range(400)] + [(1000 + i, page if i < 2 else plain, "manual") for i in range(400)]
    kept = {r.doc_id: r.kept for r in hostrules.host_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(kept[i] for i in range(300)) and all(kept[i] for i in kept if i >= 300)


def test_large_hosts(spark):
    """Verdicts of large hosts come by another way, with the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("source")))
    want = sorted(map(tuple, hostrules.host_rules(docs).collect()))
    for hot in (1, 12):
        assert sorted(map(tuple, hostrules.host_rules(docs, hot=hot).collect())) == want


# ----------------------------------------------------------------------------------------------------------- mixing


def test_exact_weights():
    """Targets with fractions: less than one block off over a million slots, phases included."""
    for weights in ({"a": 1 / 3, "b": 1 / 3, "c": 0.33328, "d": 0.00005}, {"a": 0.7, "b": 0.2, "c": 0.1}, mixing.TARGETS):
        parts = mixing.whole_parts(weights)
        total = sum(parts.values())
        assert all(abs(parts[s] / total - w / sum(weights.values())) < 1e-9 for s, w in weights.items())
        plan = mixing.phases(weights, {s: 10**6 for s in weights})
        for s, first, share, start, slots, size in plan:
            if start == 0:
                assert first == 0 and size == total and share == parts[s]
                every = np.array(slots)
                at = (np.arange(-(-(10**6) // size))[:, None] * size + every[None, :]).reshape(-1)
                at = at[at < 10**6]
                k = np.arange(len(at))
                # before its k-th slot a source has k blocks, after it k + 1
                assert (np.abs(k - at * parts[s] / total) < 1).all() and (np.abs(k + 1 - (at + 1) * parts[s] / total) < 1).all()


def test_mixing_is_earliest_deadline_first(spark):
    """The slots of a table against a plain simulation, source by source."""
    sizes, weights, block = {"a": 57, "b": 40, "c": 13, None: 5}, {"a": 5, "b": 3, "c": 1.5, None: 0.5}, 2
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), weights, block=block).collect()
    got = {r.slot: (r.source, r.block) for r in out}
    left, done, t, want = {s: -(-n // block) for s, n in sizes.items()}, dict.fromkeys(sizes, 0), 0, {}
    while left:
        total, base, had = sum(weights[s] for s in left), t, dict.fromkeys(left, 0)
        while all(left.values()):
            due = [(-(-(had[s] + 1) * total * 2 // (weights[s] * 2)), had[s] * total * 2 // (weights[s] * 2), str("0" if s is None else f"1{s}"), s) for s in left if had[s] * total // weights[s] <= t - base]
            s = min(due)[3]
            want[t] = (s, done[s])
            had[s], done[s], left[s], t = had[s] + 1, done[s] + 1, left[s] - 1, t + 1
        left = {s: n for s, n in left.items() if n}
    assert got == want


# ---------------------------------------------------------------------------------------------------------- packing


def padding(lengths):
    return sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths)


def test_packing_keeps_all_limits():
    """Tokens, segments and loss-bearing tokens of each sequence, each token once, and nothing padded."""
    rng = np.random.default_rng(8)
    for length, segments, loss in ((128, 5, 100), (128, 3, 128), (64, 64, 20)):
        p, sizes, free = packing.Packer(length, segments, loss, 0), {}, {}
        for i in range(400):
            n = int(rng.integers(1, 400 if i % 9 == 0 else 30))
            sizes[i], free[i] = n, int(n * rng.random())
            p.add(i, np.arange(n, dtype=np.uint32), free[i])
        p.finish()
        by, got = defaultdict(list), defaultdict(list)
        for doc, start, n, ids, total, sequence, at in p.rows:
            assert np.frombuffer(ids, "<u4").tolist() == list(range(start, start + n)) and total == sizes[doc]
            by[sequence].append((at, n, n - min(n, max(0, free[doc] - start))))
            got[doc] += range(start, start + n)
        assert all(sorted(got[i]) == list(range(n)) for i, n in sizes.items())
        for parts in by.values():
            parts.sort()
            assert [x[0] for x in parts] == [sum(y[1] for y in parts[:k]) for k in range(len(parts))]
            size = sum(x[1] for x in parts)
            assert size <= length and len(parts) <= segments and sum(x[2] for x in parts) <= loss
            assert size == length or size & (size - 1) == 0


def test_short_texts_are_not_padded(spark):
    df = spark.createDataFrame([(i, "hi there") for i in range(3000)], "doc_id long, text string")
    rows = packing.pack_examples(df).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r.n for r in rows) == 9000 and padding(r.n for r in rows) == 0


def test_packing_holds_little(monkeypatch):
    """A large batch is encoded in pieces, which change nothing, and a word that is kept takes few bytes."""
    rng = random.Random(21)
    some = ["".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(500)]
    texts = [" ".join(rng.choices(some, k=600)) for _ in range(900)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(900)), "text": texts, "prompt_share": [0.0] * 900})
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    task = lambda: [r for b in packing._pack(iter([batch]), packing.tokenizer_path(), 2, 4096, 16, 3968) for r in b.to_pylist()]
    task()  # loads the model
    tracemalloc.start()
    try:
        got, peak = task(), tracemalloc.get_traced_memory()[1]
        encoder = packing.Encoder(packing.tokenizer_path(), 2)
        raw = np.frombuffer(" ".join(f"{i:x}" for i in range(40_000)).encode(), np.uint8)
        before = tracemalloc.get_traced_memory()[0]
        encoder.encode(raw, np.array([0, len(raw)], np.int64))
        kept = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    monkeypatch.setattr(packing, "PIECE", 1 << 14)
    assert got == task() and {r["doc_id"] for r in got} == set(range(900))
    assert peak < 120e6 and kept < 60 * 40_000


def test_packing_query(spark):
    """The limits bind on documents; the digests are those of the ids."""
    rows = QUERIES["op7_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack_examples(packing.prompted(docs), loss=packing.LOSS, prompt_share="prompt_share").collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in rows) == sorted((r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in pieces)
    size, segments = Counter(), Counter()
    for r in rows:
        size[r.sequence_id] += r.length
        segments[r.sequence_id] += 1
    assert padding(size.values()) == 0 and max(segments.values()) <= packing.SEGMENTS
    assert any(n == packing.LENGTH for n in size.values())


# ------------------------------------------------------------------------------------------------------- classifier


def test_character_grams_stay_inside_words():
    """The n-grams of whole characters inside words with border marks, of each text its own, against plain code."""
    texts = ["", "  ", "ab", "é 𝄞x\n\tabc ", "a  b", "x" * 9, " lead", "trail "]
    data = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
    points, own = quality.characters(np.frombuffer(b"".join(data), np.uint8), off)
    got = defaultdict(str)
    for c, d in zip(points.tolist(), own.tolist(), strict=True):
        got[d] += chr(c)
    for i, t in enumerate(texts):
        assert got[i].split() == t.split()
    kinds = list(quality.features(Words(np.frombuffer(b"".join(data), np.uint8), off)))
    for i, t in enumerate(texts):
        words = t.split()
        want = [len(words), max(0, len(words) - 1)] + [sum(max(0, len(w) + 2 - k + 1) for w in words) for k in quality.GRAMS]
        assert [int((doc == i).sum()) for _, doc in kinds] == want


def test_scores_do_not_depend_on_the_batch():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta!!", "delta!!"]) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    model = quality.Model.fit(texts, [int("!!" not in t) for t in texts])
    data = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in data])]).astype(np.int64)
    both = model.scores(np.frombuffer(b"".join(data), np.uint8), off)
    alone = [model.scores(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[0] for d in data]
    assert np.allclose(both, alone, atol=1e-5)


# ---------------------------------------------------------------------------------------------------- personal data


def test_overlap_chain(spark):
    """Of a chain in which only neighbours overlap the two ends stay, if the middle one loses against one of them."""
    model = pii.Model([], 0.0, dict.fromkeys(pii.KINDS, -1.0))
    text = "call 0301 2345 6789 0123 4567, or write to anna at 0171 234 5678 dot com"
    row = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    spans = sorted((s.s, s.e) for s in row.spans)
    assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    z = [("c", 0, 10, 3.0), ("b", 8, 20, 2.0), ("a", 18, 30, 1.0)]
    df = spark.createDataFrame([(1, [x for x in z])], "i int, _z array<struct<kind:string,s:int,e:int,z:double>>")
    assert [x.kind for x in df.select(F.expr(pii.KEPT).alias("k")).first().k] == ["c", "a"]


def test_written_by_hand(spark):
    """Sentences that no generator made: numbers and addresses told as such are found, dates and versions are left."""
    private = ["reach me at jane dot doe at example dot org tonight", "my card is 4111.1111.1111.1111 thanks", "call (212) 555-0147 after six", "phone: 030-123-4567", "host fe80:1234:abcd:0001:0002:0003:0004:0005 is down"]
    plain = ["version 10.2.33 came out on 2021-03-04", "pages 110-125 of the volume", "we met at noon. dot by dot", "scores 10 20 30 40", "order 1234-5678"]
    df = spark.createDataFrame(list(enumerate(private + plain)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    assert sum(bool(found[i]) for i in range(len(private))) >= 4
    assert not any(found[i] for i in range(len(private), len(private) + len(plain)))
