"""Personal data by candidate gradient boosting, in SQL functions only.

Generators of high recall propose spans that may overlap: the base patterns (email, ip, card, phone) and looser forms of
each kind (addresses spelt with at and dot, numbers without a plus, cards with other separators, hexadecimal
addresses).  A candidate's format and context are turned into FEATURES; boosted trees, fitted by numpy and written out as one
SQL expression, score it; a threshold for each kind, calibrated on examples the trees have not seen, selects.
Base spans that pass their checks always stay; an added span overlaps no base span, and of added ones that overlap each
other the best stays, then the best of those that overlap none that stays (ties: the earlier, then the longer).

The trees learn from EXAMPLES sentences made by a seeded rule, so the same spans are chosen whatever the corpus or its size.
Fitting sees their features only, through the same SQL.  No row leaves its task: there is no shuffle, join or
group.  Matches are found by regexp_extract_all, positions by the lengths of what split leaves between them.

The base patterns are written with possessive loops and a start that is no later part of a run (or follows a match):
this finds the same leftmost matches in time linear in the text, without a deep stack on long runs.

Cases: null is the empty text, without spans; repeated rows are searched each; a null doc_id stays null; an empty
table gives an empty result; other columns are ignored; very long texts and runs are searched whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LOCAL, HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Texts without this can't match; it keeps the patterns off most texts.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
AT, DOT = r" ?(?:\(at\)|\[at\]|\{at\}| at ) ?", r" ?(?:\(dot\)|\[dot\]|\{dot\}| dot ) ?"
LOOSE = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}++{AT}{HOST}++(?:(?:{DOT}|\.){HOST}++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){3}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,2}[0-9]{2,5}){1,5}(?![0-9A-Za-z])",
}
#: What a text must have for the loose pattern to be tried.
HINT = {"email": r"(?i)[ (\[{](?:at)[ )\]}]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "card": r"[0-9]{4}[ ./_-]{1,2}[0-9]{4}", "phone": r"[0-9]\)?[ ./-]{1,2}[0-9]{2}"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
AROUND, CHUNK = 28, 128
FEATURES = ("chars", "digits", "groups", "longest", "shortest", "brackets", "slashes", "luhn", "led_by_zero", "dots", "told", "denied", "capital", "ending")
EXAMPLES, ROUNDS, DEPTH, RATE, PRECISION = 2_000, 30, 3, 0.3, 0.98
SPAN = "array<struct<s:int,e:int,m:string>>"
TOLD = r"(?i)(?:phone|call|tel|fax|mobile|dial|reach|mail|contact|write|card|visa|credit|pay|paid|server|address|host|ip)\W*+(?:\w+\W+){0,2}$"
DENIED = r"(?i)(?:date|on|version|isbn|order|page|pages|vol|no|id|from|between|score|price|invoice|years?|section|time)\W*+(?:\w+\W+){0,1}$"


#: SQL: of the added spans _z, best first, each stays if it overlaps none that stays already; most texts have no overlap at all.
_BEST = "array_sort(_z, (a, b) -> CASE WHEN a.z > b.z THEN -1 WHEN a.z < b.z THEN 1 WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 WHEN a.e > b.e THEN -1 WHEN a.e < b.e THEN 1 WHEN a.kind < b.kind THEN -1 WHEN a.kind > b.kind THEN 1 ELSE 0 END)"
_STAYS = f"aggregate({_BEST}, filter(_z, x -> false), (a, x) -> IF(exists(a, y -> y.s < x.e AND x.s < y.e), a, concat(a, array(x))))"
_ORDER = "array_sort(transform(_z, x -> struct(x.s AS s, x.e AS e)))"
_SOME = f"aggregate({_ORDER}, struct(-1 AS at, false AS hit), (a, x) -> struct(greatest(a.at, x.e) AS at, a.hit OR x.s < a.at AS hit), a -> a.hit)"
KEPT = f"IF({_SOME}, {_STAYS}, _z)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(pattern: str, when: str) -> str:
    """SQL: the matches of a pattern in _t with their code-point spans."""
    q = _quoted(pattern)
    matches = f"zip_with(regexp_extract_all(_t, {q}, 0), split(_t, {q}, -1), (m, p) -> struct(m AS m, length(p) AS gap, coalesce(length(m), 0) AS n))"
    # positions are running sums: first of whole chunks, then within each, so that n matches cost about n * CHUNK steps
    chunks = f"transform(sequence(0, size(_m) DIV {CHUNK}), c -> slice(_m, c * {CHUNK} + 1, {CHUNK}))"
    sums = "transform(_k, k -> aggregate(k, 0, (a, x) -> a + x.gap + x.n))"
    step = "(a, x) -> IF(x.m IS NULL, a, struct(a.at + x.gap + x.n AS at, concat(a.out, array(struct(a.at + x.gap AS s, a.at + x.gap + x.n AS e, x.m AS m))) AS out))"
    found = f"flatten(transform(_k, (k, i) -> aggregate(k, struct(aggregate(slice(_s, 1, i), 0, (a, x) -> a + x) AS at, CAST(array() AS {SPAN}) AS out), {step}).out))"
    # let-bindings: one-element arrays whose element the lambda names
    for name, value in (("_s", sums), ("_k", chunks), ("_m", matches)):
        found = f"transform(array({value}), {name} -> {found})[0]"
    return f"CASE WHEN {when} THEN {found} ELSE CAST(array() AS {SPAN}) END"


def _luhn(digits: str) -> str:
    digit = f"(ascii(substring({digits}, length({digits}) - i + 1, 1)) - 48)"
    return f"(aggregate(sequence(1, greatest(1, length({digits}))), 0, (a, i) -> a + IF(i % 2 = 0, 2 * {digit} - IF({digit} > 4, 9, 0), {digit})) % 10 = 0)"


CHECKS = {
    "email": "true",
    "ip": f"x.m RLIKE {_quoted(f'^{OCTET}(?:[.]{OCTET}){{3}}$')}",
    "card": "x.n BETWEEN 16 AND 19 AND x.luhn",
    "phone": "x.n BETWEEN 8 AND 15",
}


def with_base(rows: DataFrame) -> DataFrame:
    """Adds _email, _ip, _card, _phone: the base spans of _t that pass their checks."""
    for kind in KINDS:
        need = f"instr(_t, '{NEEDS[kind]}') > 0" if NEEDS[kind] else "_t RLIKE '[0-9][ -]?[0-9]'"
        rows = rows.withColumn(f"_{kind}", F.expr(_spans(BASE[kind], need)))
        if kind in ("card", "phone"):
            rows = rows.withColumn(f"_{kind}", F.expr(f"transform(_{kind}, x -> struct(x.s AS s, x.e AS e, x.m AS m, regexp_replace(x.m, '[^0-9]', '') AS d))"))
            luhn = f"length(x.d) BETWEEN 16 AND 19 AND {_luhn('x.d')}" if kind == "card" else "false"
            rows = rows.withColumn(f"_{kind}", F.expr(f"transform(_{kind}, x -> struct(x.s AS s, x.e AS e, x.m AS m, length(x.d) AS n, {luhn} AS luhn))"))
        rows = rows.withColumn(f"_{kind}", F.expr(f"transform(filter(_{kind}, x -> {CHECKS[kind]}), x -> struct('{kind}' AS kind, x.s AS s, x.e AS e))"))
    return rows.withColumn("_base", F.concat(*[f"_{k}" for k in KINDS]))


def with_candidates(rows: DataFrame) -> DataFrame:
    """Adds _found: looser candidates that overlap no base span, with their features."""
    found = []
    for kind in KINDS:
        rows = rows.withColumn(f"_l{kind}", F.expr(_spans(LOOSE[kind], f"_t RLIKE {_quoted(HINT[kind])}")))
        apart = f"filter(_l{kind}, x -> NOT exists(_base, b -> b.s < x.e AND x.s < b.e))"
        found.append(f"transform({apart}, x -> struct('{kind}' AS kind, x.s AS s, x.e AS e, x.m AS m, substring(_t, greatest(1, x.s + 1 - {AROUND}), least(x.s, {AROUND})) AS before, substring(_t, x.e + 1, 2) AS after))")
    rows = rows.withColumn("_c", F.expr(f"concat({', '.join(found)})"))
    parts = "transform(_c, x -> struct(x.*, regexp_replace(x.m, '[^0-9]', '') AS d, filter(split(x.m, '[^0-9A-Za-z]+'), g -> g <> '') AS g))"
    parts = parts.replace("x.*", "x.kind AS kind, x.s AS s, x.e AS e, x.m AS m, x.before AS before, x.after AS after")
    rows = rows.withColumn("_c", F.expr(parts))
    number = {
        "chars": "length(x.m)",
        "digits": "length(x.d)",
        "groups": "size(x.g)",
        "longest": "coalesce(array_max(transform(x.g, y -> length(y))), 0)",
        "shortest": "coalesce(array_min(transform(x.g, y -> length(y))), 0)",
        "brackets": "length(x.m) - length(translate(x.m, '()[]{}', ''))",
        "slashes": "length(x.m) - length(translate(x.m, '/_', ''))",
        "luhn": f"IF(length(x.d) BETWEEN 12 AND 19 AND {_luhn('x.d')}, 1, 0)",
        "led_by_zero": "IF(x.m LIKE '0%' OR x.m LIKE '(0%', 1, 0)",
        "dots": "length(x.m) - length(replace(x.m, '.', ''))",
        "told": f"IF(x.before RLIKE {_quoted(TOLD)}, 1, 0)",
        "denied": f"IF(x.before RLIKE {_quoted(DENIED)}, 1, 0)",
        "capital": "IF(x.before RLIKE '[A-Z]\\\\W*$', 1, 0)",
        "ending": "IF(x.after RLIKE '^[.,;!?]?(?:\\\\s|$)', 1, 0)",
    }
    features = ", ".join(f"CAST({number[f]} AS DOUBLE) AS {f}" for f in FEATURES)
    return rows.withColumn("_found", F.expr(f"transform(_c, x -> struct(x.kind AS kind, x.s AS s, x.e AS e, x.m AS m, {features}))"))


# ---------------------------------------------------------------------------------------------- examples and fitting


def examples(n: int = EXAMPLES, seed: int = 11) -> list[tuple[str, list[str]]]:
    """Sentences and the personal data in them, of the kinds that the base patterns miss, among numbers that are none."""
    random = np.random.default_rng(seed)
    pick = lambda *x: x[int(random.integers(len(x)))]
    digits = lambda k, first="": first + "".join(str(int(d)) for d in random.integers(0, 10, k - len(first)))
    word = lambda: "".join(pick(*"bcdfglmnprst") + pick(*"aeiou") for _ in range(int(random.integers(1, 5))))

    def number(right: bool) -> str:
        d = digits(15, pick("4", "5", "37", "6011"))
        total = sum((int(c) * 2 - 9 * (int(c) > 4)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(d)))
        return d + str((-total + (0 if right else int(random.integers(1, 10)))) % 10)

    fours = lambda d, sep: sep.join(d[i : i + 4] for i in range(0, 16, 4))
    private = {
        "email": lambda: f"{word()}{pick('.', '_', '')}{word()}{pick(' at ', ' (at) ', '[at]', '(at)', ' [at] ')}{word()}{pick(' dot ', ' (dot) ', '[dot]', '.')}{pick('com', 'org', 'net', 'de', 'fr', 'es')}",
        "ip": lambda: ":".join(f"{int(x):x}" for x in random.integers(4096, 65536, 8)),
        "card": lambda: fours(number(True), pick(".", "/", "  ", "_", " - "[:2])),
        "phone": lambda: pick(f"({digits(3, '5')}) {digits(3)}-{digits(4)}", f"{digits(3, '7')}-{digits(3)}-{digits(4)}", f"0{digits(3)} {digits(3)} {digits(4)}", f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"{digits(3, '6')}.{digits(3)}.{digits(4)}"),
    }
    lead = {"email": ("mail me:", "write to", "contact", ""), "ip": ("server", "host", "address", ""), "card": ("card", "visa", "paid with", ""), "phone": ("phone", "call", "tel.", "fax:", "reach me at", "mobile")}
    none = (
        lambda: f"{pick('on', 'date', 'from', '')} {int(random.integers(1950, 2030))}-{digits(2, '0')}-{digits(2, '1')}",
        lambda: f"{pick('version', 'v', 'section', '')} {digits(2)}.{digits(2)}.{digits(2)}",
        lambda: f"ISBN 978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
        lambda: f"{pick('scores', 'from', 'between', 'values', '')} {digits(2)} {digits(2)} {digits(2)} {digits(2)}",
        lambda: f"{pick('order', 'invoice', 'id', 'no')} {digits(4)}-{digits(4)}",
        lambda: f"{pick('pages', 'page', 'years')} {digits(3, '1')}-{digits(3, '2')}",
        lambda: fours(number(False), pick(".", "/", "_", " ", "-", "  ")),
        lambda: fours(digits(16), pick(".", "/", "_", " ", "-")),
        lambda: f"{word()} at {word()}.{word()} {word()}",
        lambda: f"met at {word()}. {word()} was there",
        lambda: f"{digits(2, '1')}:{digits(2, '3')}:{digits(2, '2')}:{digits(2)}:{digits(2)}",
        lambda: f"{pick('price', 'about', 'of', '')} {digits(3)} {digits(3)} {pick('euro', 'people', 'rows')}",
        lambda: f"{digits(2)}/{digits(2)}/{int(random.integers(1950, 2030))} {digits(2)}.{digits(2)}",
        lambda: f"{word()} at {word()} dot {word()}" if random.random() < 0.05 else f"{digits(3)} / {digits(2)}",
    )
    out = []
    for _ in range(n):
        said, spans = [word() for _ in range(int(random.integers(1, 6)))], []
        for _ in range(int(random.integers(1, 4))):
            if random.random() < 0.45:
                kind = pick(*KINDS)
                spans.append(private[kind]())
                said.append(f"{pick(*lead[kind])} {spans[-1]}{pick('', '.', ',')}")
            else:
                said.append(pick(*none)() + pick("", ".", ","))
            said += [word() for _ in range(int(random.integers(1, 5)))]
        out.append((" ".join(said), spans))
    return out


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients: (feature, cut, below, above) or a leaf's value."""
    best, total_g, total_h = (1e-6, None, None), g.sum(), h.sum()
    if depth and len(g) > 20:
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            if not len(at):
                continue
            gain = cg[at] ** 2 / (ch[at] + 1) + (total_g - cg[at]) ** 2 / (total_h - ch[at] + 1) - total_g**2 / (total_h + 1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), f, float((v[at[i]] + v[at[i] + 1]) / 2))
    if best[1] is None:
        return float(total_g / (total_h + 1) * RATE)
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], _tree(x[low], g[low], h[low], depth - 1), _tree(x[~low], g[~low], h[~low], depth - 1)


def _grow(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, cut, below, above = tree
    return np.where(x[:, f] <= cut, _grow(below, x), _grow(above, x))


def _sql(tree, names: list[str]) -> str:
    if isinstance(tree, float):
        return f"{tree:.6f}D"
    f, cut, below, above = tree
    return f"IF({names[f]} <= {cut:.4f}D, {_sql(below, names)}, {_sql(above, names)})"


class Model:
    def __init__(self, trees: list, bias: float, least: dict[str, float]):
        self.trees, self.bias, self.least = trees, bias, least

    @property
    def sql(self) -> str:
        names = [*(f"x.{f}" for f in FEATURES), *(f"IF(x.kind = '{k}', 1.0D, 0.0D)" for k in KINDS)]
        return " + ".join([f"{self.bias:.6f}D", *(_sql(t, names) for t in self.trees)])

    @property
    def selected(self) -> str:
        return " OR ".join(f"(x.kind = '{k}' AND x.z >= {v:.6f}D)" for k, v in self.least.items())


@lru_cache(maxsize=4)
def _fitted(rows: tuple) -> Model:
    kind = np.array([r[0] for r in rows])
    x = np.array([[*r[2:], *(float(r[0] == k) for k in KINDS)] for r in rows])
    y = np.array([r[1] for r in rows], float)
    held = np.arange(len(y)) % 3 == 0
    bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    z, trees = np.full(len(y), bias), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        trees.append(_tree(x[~held], (y - p)[~held], (p * (1 - p))[~held], DEPTH))
        z = z + _grow(trees[-1], x)
    least = {}
    for k in KINDS:  # the lowest margin, even odds at least, from which on the held-out precision is high enough
        own = held & (kind == k)
        order = np.argsort(-z[own], kind="stable")
        right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        least[k] = max(0.0, float(z[own][order][good[-1]])) if len(good) else 50.0
    return Model(trees, bias, least)


def fit(spark: SparkSession, n: int = EXAMPLES) -> Model:
    made = examples(n)
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "i long, _t string")
    found = with_candidates(with_base(rows)).select("i", F.explode("_found").alias("x")).select("i", "x.kind", "x.s", "x.m", *[f"x.{f}" for f in FEATURES]).collect()
    found = sorted(found, key=lambda r: (r["i"], r["s"], r["kind"]))  # here: to sort there, Spark would plan and work out all spans twice
    label = lambda r: int(any(r["m"].strip() in p or p in r["m"] for p in made[r["i"]][1]))
    return _fitted(tuple((r["kind"], label(r), *(r[f] for f in FEATURES)) for r in found))


def find_personal_data(docs: DataFrame, model: Model | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of keep, base (spans of the base patterns) and spans (all): arrays of (kind, s, e), by kind, then start."""
    model = model or fit(docs.sparkSession)
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    rows = with_candidates(with_base(rows))
    rows = rows.withColumn("_z", F.expr(f"transform(_found, x -> struct(x.kind AS kind, x.s AS s, x.e AS e, CAST({model.sql} AS DOUBLE) AS z))"))
    rows = rows.withColumn("_z", F.expr(f"filter(_z, x -> {model.selected})"))
    rows = rows.withColumn("_z", F.expr(KEPT))
    kinds = [f"array_sort(concat(_{k}, transform(filter(_z, x -> x.kind = '{k}'), x -> struct(x.kind AS kind, x.s AS s, x.e AS e))), (a, b) -> CASE WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 WHEN a.e < b.e THEN -1 WHEN a.e > b.e THEN 1 ELSE 0 END)" for k in KINDS]
    return rows.withColumn("spans", F.expr(f"concat({', '.join(kinds)})")).withColumn("base", F.col("_base")).select(*keep, "_t", *[f"_{k}" for k in KINDS], "base", "spans")


def _listed(spans: str):
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest and all spans as text."""
    found = find_personal_data(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    return found.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs, its columns as they are, with each maximal run of spans in text replaced by [KIND] of its first span; null texts stay null."""
    names = docs.columns
    held = docs.withColumn("text", F.col("text").cast("string"))
    found = find_personal_data(held.select(F.struct(*names).alias("_row"), "text"), keep=("_row",))
    order = "array_sort(spans, (a, b) -> CASE WHEN a.s < b.s THEN -1 WHEN a.s > b.s THEN 1 WHEN a.e > b.e THEN -1 WHEN a.e < b.e THEN 1 ELSE 0 END)"
    step = "(a, x) -> IF(x.e <= a.at, a, struct(x.e AS at, IF(x.s < a.at, a.out, concat(a.out, array(substring(_t, a.at + 1, x.s - a.at), concat('[', upper(x.kind), ']')))) AS out))"
    text = F.expr(f"aggregate(_o, struct(0 AS at, CAST(array() AS array<string>) AS out), {step}, a -> concat(array_join(a.out, ''), substring(_t, a.at + 1)))")
    changed = found.withColumn("_o", F.expr(order)).withColumn("_new", F.when(F.size("_o") > 0, text).otherwise(F.col("_row.text")))
    return changed.select(*[F.col("_new").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in names])
