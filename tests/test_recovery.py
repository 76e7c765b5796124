"""Likenesses against difflib, numbers of rows without a single-task sort, merged records, plans."""

import difflib
import random
import re

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF
from quillspark.functions import match
from quillspark.operators import audit, index, recovery, tables
from quillspark.plans import catalog
from quillspark.plans.projection import Domain


def test_title_lookup_is_the_best_of_five(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    titles = [" ".join(re.sub("[^a-z ]", "", r.text.lower()).split()[:6]) or "none at all" for r in docs]
    asked = [(str(i), t, "2015") for i, t in enumerate(titles)]
    hits = [(str(i), k, f"d{k}", titles[(i + k * k) % len(titles)][: 40 - k], "2015") for i in range(len(titles)) for k in range(1, 8)]
    got = {r.key: (r.doi, round(r.sim, 9)) for r in recovery.title_lookup(spark.createDataFrame(asked, "key string, title string, year string"), spark.createDataFrame(hits, "key string, at int, doi string, found string, found_year string"), least=0.3).collect()}
    want = {}
    for key, title, _ in asked:
        near = [(difflib.SequenceMatcher(None, title, f.strip()).ratio(), -at, doi) for k, at, doi, f, _ in hits if k == key and at < 5]
        sim, _, doi = max(near)
        if len(title) >= 8 and sim >= 0.3:
            want[key] = (doi, round(sim, 9))
    assert got == want


def test_numbers_follow_the_order(spark):
    rows = [(i * 7919 % 1000, f"k{i % 50:02d}", i) for i in range(3000)]
    df = tables.numbered(spark.createDataFrame(rows, "a long, b string, c int"), [-F.col("a"), F.col("b"), F.col("c")], "n")
    assert [(r.a, r.b, r.c) for r in df.orderBy("n").collect()] == sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    assert sorted(r.n for r in df.select("n").collect()) == list(range(1, 3001))
    assert tables.numbered(spark.createDataFrame([], "a long"), [F.col("a")], "n").count() == 0


def test_merge_keeps_what_is_filled(spark):
    empties = ["null", '""', "[]", "{}", "0"]
    for e in empties:
        df = spark.createDataFrame([({"year": "1990", "note": "1"}, {"year": e, "note": e})], "old map<string,string>, new map<string,string>")
        assert df.select(match.merge_records(F.col("old"), F.col("new")).alias("m")).first().m == {"year": "1990", "note": e}
    df = spark.createDataFrame([(None, {"year": "0"}), ({"year": "[]"}, {"a": "1"})], "old map<string,string>, new map<string,string>")
    assert [r.m for r in df.select(match.merge_records(F.col("old"), F.col("new")).alias("m")).collect()] == [{"year": "0"}, {"a": "1"}]


def test_plans_have_no_large_buffers(spark):
    """No set of all seeds of a paper, no sort of all lengths of a project."""
    d = Domain(spark, SF)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "collect_set(source_seed_doi" not in plan(index.top_candidates(d.candidates, d.metadata, d.locations))
    assert "row_number" not in plan(audit.upper_median(d.locations, ["project"], "sidecar_text_len"))
    assert "row_number" not in plan(audit.collision_safe(d.locations, "pdf_filename", "doi", F.lit("x")))


def closest_by_hand(rows):
    """All ordered pairs of a block, with difflib."""
    best = {}
    bare = [(k, re.sub(" +", " ", re.sub("[^a-z0-9 ]", " ", (t or "").lower())).strip(), b) for k, t, b in rows if k is not None and b is not None]
    for k, t, b in bare:
        for k2, t2, b2 in bare:
            if b == b2 and k != k2 and (sim := difflib.SequenceMatcher(None, t, t2).ratio()) >= 0.85:
                best[k] = max(best.get(k, (0, 0)), (sim, -k2))
    return {k: (-k2, sim) for k, (sim, k2) in best.items()}


def test_closest_titles_are_those_of_all_pairs(spark):
    """Edited titles of 0 to 40 letters over few and many letters, copies, keys that come twice, nulls."""
    r = random.Random(5)
    rows = [(k, t, "z") for k, t in enumerate(["abc", "abxc", "a b c", "ab", "a", "", None, "?", "abcdef", "abcdefg", "abcdeg", "ab"])]
    for size in range(1, 41):
        for letters in ("ab", "abc ", "abcdefghijklmnopqrstuvwxyz 0123456789"):
            t = "".join(r.choices(letters, k=size))
            for _ in range(4):
                u = list(t)
                for _ in range(r.randint(0, 1 + size // 7)):
                    i = r.randrange(len(u) + 1)
                    u[i : i + r.randint(0, 2)] = r.choices(letters, k=r.randint(0, 2))
                rows.append((len(rows) - (r.random() < 0.05), "".join(u), r.choice("xxxxy")))
    rows += [(None, "abcdefg", "z"), (len(rows), "abcdefg", None), (3, "abcdefgh", "z"), (3, "abcdefg", "z")]
    df = spark.createDataFrame(rows, "k long, title string, b string")
    got = {x.k: (x.match, x.similarity) for x in recovery.closest_titles(df, "k", "title", ["b"]).collect()}
    want = closest_by_hand(rows)
    assert got == want and sum(s < 1 for _, s in want.values()) > 100
    assert recovery.closest_titles(df.limit(0), "k", "title", ["b"]).count() == 0


def test_fuzzy_best_does_not_compare_all_rows(spark, tmp_path, monkeypatch):
    """Copies and titles that can't be alike never get to the ratio."""
    rows = [(k, f"{'red blue new old'.split()[k % 4]} {'ring bolt gear plate rod'.split()[k // 4 % 5]}") for k in range(600)] + [(600, "rod plates"), (601, "olds plate")]
    spark.createDataFrame([(k, t, "a", "b") for k, t in rows], "p_partkey long, p_name string, p_type string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    seen, ratio = spark.sparkContext.accumulator(0), match.title_similarity.func

    @F.pandas_udf("double")
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        seen.add(len(a))
        return ratio(a, b)

    for module in (match, recovery):
        monkeypatch.setattr(module, "title_similarity", counted)
    got = {x.p_partkey: (x.match, x.similarity) for x in catalog.QUERIES["j10_f20_fuzzy_best"](spark, str(tmp_path)).collect()}
    assert got == closest_by_hand([(k, t, "") for k, t in rows]) and 601 in got
    assert seen.value < 100
