"""Secret scans in DataFrame operations only: fixed kinds by pattern, and strings that a battery of randomness tests
tells from written text.

Candidates are runs of letters, digits and + / _ = - of CANDIDATE characters and more. The encoding is inferred (hex,
base 32, base 36, base 64) and gives the alphabet. Three statistics are taken: chi-squared uniformity over the alphabet, runs (of
capitals, small letters, digits, others), and the serial correlation of neighbouring values. A candidate must be
consistent with a uniform draw from its alphabet in all three (GATE standard deviations), and it must refute that it is
written text, of which few class changes, uneven letters and like neighbours are expected: the three p-values are
combined (weighted z-scores; the serial test, which tells least, at half weight), and the false discoveries among all candidates of a length class in the table are controlled at rate FDR (Benjamini-Hochberg over a
histogram of p-values, so that no task sorts the candidates). Short strings have too little evidence for that and are
left alone unless a fixed kind matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: The kinds in their order, and their patterns. The last group is the value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{24,})"
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
FDR, GATE = 1e-3, 4.0
#: Of written text: chance that two characters are equal, that neighbours differ in class; third moment of frequencies.
SAME, CHANGES, CUBES = 0.066, 0.08, 0.006
#: And the correlation of neighbours' places in the alphabet (both lie among the small letters), and that test's weight.
LAG, SERIAL = 0.15, 0.5
LENGTHS = (32, 48, 64)
#: Values that before() folds at a time; with more spans than MANY, a text is masked as an array of characters.
BLOCK, MANY = 64, 64
#: Encodings in the order they are tried, their alphabets, and the sizes of these' classes of characters.
#: Anything else is taken for base 64.
ENCODINGS = [
    ("[0-9a-f]+", "0123456789abcdef", (10, 6)),
    ("[0-9A-F]+", "0123456789ABCDEF", (10, 6)),
    ("[A-Z2-7]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", (26, 6)),
    ("[0-9a-z]+", "0123456789abcdefghijklmnopqrstuvwxyz", (10, 26)),
    ("[0-9A-Z]+", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", (10, 26)),
]
_SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def before(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Of each value of an array, what op makes of zero and all values before it. Blocks of BLOCK values are folded once,
    and so are blocks of these: the steps are in proportion to the array's length, and nothing is appended to."""
    once = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)  # noqa: E731  the value is worked out once
    blocks = lambda array: F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(array, b * BLOCK + 1, F.lit(BLOCK)), zero, op))

    def folded(v: Column, b: Column, bb: Column) -> Column:
        def of(_: Column, i: Column) -> Column:
            own, high = F.floor(i / BLOCK).cast("int"), F.floor(i / BLOCK**2).cast("int")
            acc = zero
            for part in (F.slice(bb, F.lit(1), high), F.slice(b, high * BLOCK + 1, own - high * BLOCK), F.slice(v, own * BLOCK + 1, i - own * BLOCK)):
                acc = F.aggregate(part, acc, op)
            return acc

        return F.transform(v, of)

    made = once(values, lambda v: once(blocks(v), lambda b: once(blocks(b), lambda bb: folded(v, b, bb))))
    return F.when(F.size(values) > 0, made).otherwise(F.transform(values, lambda v: zero))


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Array of the leftmost non-overlapping matches: start, kind, end in code points, value of the group. Positions are
    running sums over the pieces between matches and the matches."""
    hits = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"), F.regexp_extract_all(text, F.lit(pattern), 1).alias("value"))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("bigint"))
    step = lambda gap, m: F.struct(gap.alias("gap"), (gap + F.char_length(m["hit"])).alias("step"), m["value"].alias("value"))
    steps = F.filter(F.zip_with(gaps, hits, step), lambda x: x["step"].isNotNull())

    def placed(s: Column) -> Column:
        sums = before(F.transform(s, lambda x: x["step"]), F.lit(0).cast("bigint"), lambda a, b: a + b)
        span = lambda at, x: F.struct((at + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (at + x["step"]).alias("end"), x["value"].alias("value"))
        return F.zip_with(sums, s, span)

    return F.when(text.rlike(pattern), F.element_at(F.transform(F.array(steps), placed), 1)).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


def _tail(z: Column) -> Column:
    """-log10 of (an upper bound of) the normal tail beyond z, 0 up to z = 1."""
    return F.when(z > 1, (z * z / 2 + F.log(z * 2.5066282746)) / F.log(F.lit(10.0))).otherwise(F.lit(0.0))


def battery(value: Column) -> Column:
    """Evidence (-log10 p) that value isn't written text, 0 if it isn't consistent with a uniform draw."""
    base64 = ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", (26, 26, 10, 2))
    known = lambda alphabet, classes: F.struct(F.lit(alphabet).alias("alphabet"), F.lit(float(len(alphabet))).alias("a"), F.lit(1 - sum((c / len(alphabet)) ** 2 for c in classes)).alias("change"))
    encoding = F
    for pattern, *own in ENCODINGS:
        encoding = encoding.when(value.rlike(f"^{pattern}$"), known(*own))
    encoding = encoding.otherwise(known(*base64[1:]))
    text = F.rtrim(F.translate(value, "-_", "+/"), F.lit("="))
    letters = lambda t: F.filter(F.split(t, ""), lambda c: c != "")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    s = F.struct(encoding.alias("e"), letters(text).alias("c"), letters(kinds).alias("k"))

    def of(s: Column) -> Column:
        n, a, change = F.size(s["c"]).cast("double"), s["e"]["a"], s["e"]["change"]
        squares = F.aggregate(F.transform(F.array_distinct(s["c"]), lambda x: F.pow(F.size(F.filter(s["c"], lambda y: y == x)), 2)), F.lit(0.0), lambda p, q: p + q)
        flips = F.aggregate(F.zip_with(F.slice(s["k"], 2, F.size(s["k"])), F.slice(s["k"], F.lit(1), F.size(s["k"]) - 1), lambda p, q: (p != q).cast("double")), F.lit(0.0), lambda p, q: p + q)
        v = F.transform(s["c"], lambda c: F.position(c, s["e"]["alphabet"]) - (a + 1) / 2)
        lag = lambda v: F.aggregate(F.zip_with(F.slice(v, 2, F.size(v)), F.slice(v, F.lit(1), F.size(v) - 1), lambda p, q: p * q), F.lit(0.0), lambda p, q: p + q)
        found = F.struct(n.alias("n"), a.alias("a"), change.alias("change"), (squares * a / n - n).alias("chi"), flips.alias("flips"), (F.transform(F.array(v), lag)[0] / ((a * a - 1) / 12.0) / F.sqrt(n - 1)).alias("serial"))
        return F.transform(F.array(found), judged)[0]

    def judged(f: Column) -> Column:
        n, a, change, chi, flips, serial = (f[c] for c in ("n", "a", "change", "chi", "flips", "serial"))
        z_chi = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (1 - 1 / n))
        z_runs = (flips - change * (n - 1)) / F.sqrt(change * (1 - change) * (n - 1))
        uniform = (F.abs(z_chi) <= GATE) & (F.abs(z_runs) <= GATE) & (F.abs(serial) <= GATE)
        uneven = (a - 1) + (n - 1) * F.greatest(F.lit(0.5), a * SAME - 1)
        by_chi = (uneven - chi) / (F.sqrt(2 * (a - 1)) + 2 * a * F.sqrt(n * (CUBES - SAME * SAME)))
        by_runs = (flips - 0.5 - CHANGES * (n - 1)) / F.sqrt(CHANGES * (1 - CHANGES) * (n - 1))
        together = (by_chi + by_runs + SERIAL * (LAG * F.sqrt(n - 1) - serial)) / (2 + SERIAL**2) ** 0.5
        return F.when((n >= 20) & uniform, F.transform(F.array(together), _tail)[0]).otherwise(F.lit(0.0))

    return F.when(F.char_length(text) > 1, F.transform(F.array(s), of)[0]).otherwise(F.lit(0.0))


def apart(tries: Column, base: str) -> Column:
    """The spans of tries that no span of base overlaps: in the order of their starts, those that begin after all earlier
    base spans end, and end before the next one begins."""
    far = F.lit(1 << 62)
    of = lambda spans, own: F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(own).alias("own"), m["end"].alias("end"), (m["value"] if own else F.lit(None).cast("string")).alias("value")))

    def clear(x: Column) -> Column:
        reached = before(F.transform(x, lambda m: F.when(m["own"], 0).otherwise(m["end"])), F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b))
        ahead = F.reverse(before(F.reverse(F.transform(x, lambda m: F.when(m["own"], far).otherwise(m["start"]))), far, lambda a, b: F.least(a, b)))
        room = F.zip_with(reached, ahead, lambda a, b: F.struct(a.alias("from"), b.alias("to")))
        kept = F.filter(F.zip_with(x, room, lambda m, r: F.struct(m.alias("m"), (m["own"] & (m["start"] >= r["from"]) & (m["end"] <= r["to"])).alias("free"))), lambda y: y["free"])
        return F.transform(kept, lambda y: F.struct(y["m"]["start"].alias("start"), F.lit(3).alias("kind"), y["m"]["end"].alias("end"), y["m"]["value"].alias("value")))

    return F.element_at(F.transform(F.array(F.array_sort(F.concat(of(F.col(base), False), of(tries, True)))), clear), 1)


def with_matches(docs: DataFrame) -> DataFrame:
    """docs with base (spans of the fixed kinds, by start and kind) and tries (candidates that touch none of them, with
    their evidence); a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(matches(text, ASSIGN, 0), lambda m: F.char_length(m["value"]) >= 6)
    access = F.filter(matches(text, ACCESS, 1), lambda m: F.char_length(m["value"]) >= 20)
    base = F.array_sort(F.concat(assign, access, matches(text, HEX, 2)))
    found = docs.withColumn("base", F.transform(base, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))))
    tries = F.element_at(F.transform(F.array(matches(text, CANDIDATE, 3)), lambda t: F.when(F.size(t) > 0, apart(t, "base")).otherwise(t)), 1)
    length = lambda m: m["end"] - m["start"]
    group = lambda m: sum((length(m) >= n).cast("int") for n in LENGTHS)
    return found.withColumn("tries", F.transform(tries, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"), group(m).alias("group"), F.floor(battery(m["value"]) * 10).cast("int").alias("bin"))))


def thresholds(found: DataFrame) -> list[int | None]:
    """By length class, the smallest bin of evidence (tenths of -log10 p) that is a discovery, None if none. Candidates
    are counted before they are shuffled; only these four numbers come to the driver."""
    counts = found.select(F.explode("tries").alias("m")).groupBy("m.group", F.least(F.col("m.bin"), F.lit(3000)).alias("bin")).count()
    by = Window.partitionBy("group")
    down = by.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    cut = counts.withColumn("so_far", F.sum("count").over(down)).withColumn("total", F.sum("count").over(by))
    cut = cut.where((F.col("bin") > 0) & (F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("total") <= FDR * F.col("so_far")))
    return list(cut.agg(*[F.min(F.when(F.col("group") == g, F.col("bin"))) for g in range(len(LENGTHS) + 1)]).first())


def with_spans(found: DataFrame, least: list[int | None]) -> DataFrame:
    """found with spans: the base spans and the discoveries, by start and kind."""
    limit = F.array(*[F.lit(x).cast("int") for x in least])
    hits = F.filter("tries", lambda m: F.coalesce(m["bin"] >= F.element_at(limit, m["group"] + 1), F.lit(False)))
    hits = F.transform(hits, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    return found.withColumn("spans", F.array_sort(F.concat("base", hits)))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in ("assign", "access", "hex", "random")])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.element_at(names, m["kind"] + 1), m["start"].cast("string"), m["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans (arrays of start, kind, end) of every row, whole texts. A null text is empty and has none;
    repeated rows give repeated results; an empty table gives none. Matches are stored once (without the texts), then
    the discoveries' thresholds are taken from them."""
    found = stored(with_matches(docs.select("doc_id", "text")).select("doc_id", "base", "tries"), "secrets")
    return with_spans(found, thresholds(found))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """docs with every secret in text replaced by mask (n_chars, if there, counts anew); all rows stay. Spans that
    overlap are replaced as one. Rows without a secret, null texts too, stay as they are, and so do all other columns,
    whatever their names. An empty table gives none. Rows and matches are stored once, then the thresholds are taken."""
    columns, row = docs.columns, F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
    found = stored(with_matches(docs.select(row.alias("_row"), "text")), "secrets")
    out = with_spans(found, thresholds(found))
    # A span that begins before an earlier one ends is masked with it.
    ends = F.transform("spans", lambda m: m["end"])
    reached = before(ends, F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b))
    kept = F.filter(F.zip_with(reached, "spans", lambda at, m: F.struct(at.alias("at"), m["start"].alias("start"))), lambda p: p["start"] >= p["at"])

    def masked(part: Callable[[Column, Column], Column]) -> Column:
        """The text's parts before each mask, and the rest; part: of the text, from a place, so many characters."""
        return F.concat(F.array_join(F.transform(kept, lambda p: F.concat(part((p["at"] + 1).cast("int"), (p["start"] - p["at"]).cast("int")), F.lit(mask))), ""), part((F.array_max(ends) + 1).cast("int"), F.char_length("text")))

    # substring() walks from the text's beginning each time; with many spans, the text is taken apart once.
    letters = F.filter(F.split("text", ""), lambda c: c != "")
    many = F.element_at(F.transform(F.array(letters), lambda c: masked(lambda at, n: F.array_join(F.slice(c, at, n), ""))), 1)
    few = masked(lambda at, n: F.substring(F.col("text"), at, n))
    out = out.withColumn("text", F.when(F.size("spans") > MANY, many).when(F.size("spans") > 0, few).otherwise(F.col("text")))
    fresh = {"text": F.col("text")}
    if "n_chars" in columns:
        own = F.col("_row")[f"c{columns.index('n_chars')}"]
        fresh["n_chars"] = F.when(F.size("spans") > 0, F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(own)
    return out.select(*[(fresh[c] if c in fresh else F.col("_row")[f"c{i}"]).alias(c) for i, c in enumerate(columns)])
