"""Secret scans with column expressions only.

Three kinds of secrets have a pattern: assignments, access keys and long hexadecimal runs. A
fourth, ``random``, is any long run of token characters that looks drawn at random. Its evidence
is a battery of three tests, each against what written text would give in the encoding inferred
from the characters used:

- chi-squared distance from equal use of the alphabet, which is far larger in text;
- runs: changes between digits, small and capital letters, which are rare in text, and changes
  between vowels and consonants, which are frequent in text;
- serial correlation of neighbouring symbols, which is high where classes stay together.

Which of them say something depends on the encoding. Hexadecimal digits have no syllables, and
letters of one case no changes of class. Names in mixed case change it often, so there the first
changes and the correlation count for no more than two deviations and the vowels for more. Decimal
digits of text and of secrets look alike, so that decimal runs are never discovered.

The tests are combined into one p-value, and the Benjamini-Hochberg procedure decides which runs
are discoveries, separately by encoding and by doubling of the length: a short run has little
evidence and is judged among its like. Copies of a run count once. The procedure needs only the
histogram of p-values over all distinct runs, a bounded table. Shorter runs than ``least_run`` (20
characters) are not tested.

Regular expressions give matches and the text between them; positions are sums of their lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.frames import fresh, materialise, numbered

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: A run that is too short fails at every place in it, so the least length may be in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets in the order in which they are tried; the first that has all characters is inferred.
ENCODINGS = {
    "decimal": DIGITS,
    "hex": DIGITS + LOWER[:6],
    "HEX": DIGITS + UPPER[:6],
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": UPPER + LOWER + DIGITS,
}
#: Encodings with letters of one case alone, and those that have syllables beside digits.
ONE_CASE, MIXED = ("lower", "upper"), ("base32", "base36", "BASE36")
VOWELS = "aeiouyAEIOUY"
_BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda in it uses the value often.

    Columns of an inner projection give no such guarantee: the optimizer may put their expression
    into a lambda.
    """
    return F.transform(F.array(value), body)[0]


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` of each value with all before it, from 0; by blocks, so that the work stays
    nearly in proportion to the number of values."""

    def over(v: Column) -> Column:
        def part(at: Column, n: Column | int) -> Column:
            return F.aggregate(F.slice(v, at + 1, n), F.lit(0), combine)

        last = F.floor((F.size(v) - 1) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: part(b * _BLOCK, _BLOCK))

        def before(w: Column) -> Column:
            return F.transform(
                w, lambda _, b: F.aggregate(F.slice(w, F.lit(1), b), F.lit(0), combine)
            )

        def ended(e: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                return combine(e[block], part(block * _BLOCK, i % _BLOCK + 1))

            return F.transform(v, one)

        return _let(blocks, lambda w: _let(before(w), ended))

    return _let(values, over)


_SPAN = "array<struct<start: bigint, order: int, end: bigint, kind: string>>"


def _spans(text: Column, matches: Column, pattern: str, kind: str, order: int) -> Column:
    """Spans of the pattern's matches. A match ends where the lengths of the matches and of the
    text between them, up to it, add up to."""

    def lengths(gaps: Column) -> Column:
        return F.transform(matches, lambda m, i: F.length(m) + F.length(gaps[i]))

    def span(m: Column, end: Column) -> Column:
        return F.struct(
            (end - F.length(m)).cast("long").alias("start"),
            F.lit(order).alias("order"),
            end.cast("long").alias("end"),
            F.lit(kind).alias("kind"),
        )

    ends = _running(_let(F.split(text, pattern, -1), lengths), lambda a, x: a + x)
    found = _let(ends, lambda e: F.transform(matches, lambda m, i: span(m, e[i])))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(_SPAN))


def _upper_tail(z: Column) -> Column:
    """Share of the standard normal distribution above ``z``."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (
        0.319381530
        + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def randomness(
    runs: DataFrame,
    token: str,
    excess: float = 0.5,
    changes: float = 0.15,
    serial: float = 0.3,
    syllables: float = 0.6,
) -> DataFrame:
    """Adds ``encoding``, ``n`` (symbols) and ``evidence`` (minus the decimal logarithm of p).

    What text would give: a chi-squared distance of ``excess`` for each symbol above the random
    one, a change of class at a share ``changes`` of places, one between vowel and consonant at a
    share ``syllables`` of pairs of letters, a serial correlation of ``serial``.
    """
    # Punctuation in a token is padding or separates groups; it says nothing of its symbols.
    df = runs.withColumn("symbols", F.regexp_replace(token, "[^A-Za-z0-9]", ""))
    encoding, alphabet = F.lit("base62"), F.lit(ENCODINGS["base62"])
    for name, letters in reversed(list(ENCODINGS.items())[:-1]):
        inside = F.translate("symbols", letters, "") == ""
        encoding = F.when(inside, name).otherwise(encoding)
        alphabet = F.when(inside, letters).otherwise(alphabet)
    df = df.withColumns(
        {"encoding": encoding, "alphabet": alphabet, "n": F.length("symbols")}
    ).withColumns(
        {
            "k": F.length("alphabet"),
            "chars": F.split("symbols", "(?!^)(?!$)"),
            "classes": F.translate(
                "symbols", DIGITS + LOWER + UPPER, "0" * 10 + "a" * 26 + "A" * 26
            ),
            "sounds": F.translate(
                "symbols", VOWELS + DIGITS + LOWER + UPPER, "v" * 12 + "0" * 10 + "c" * 52
            ),
        }
    )
    df = df.withColumn(
        "values", F.expr("transform(chars, c -> cast(instr(alphabet, c) AS double))")
    )
    df = df.withColumns(
        {
            "squares": F.expr(
                "aggregate(array_distinct(chars), 0D, (a, c) -> a + "
                "power(n - length(replace(symbols, c, '')), 2))"
            ),
            "mean": F.expr("aggregate(values, 0D, (a, v) -> a + v) / n"),
            # A change is a character that differs from the next one in its class.
            "moves": F.length(F.regexp_replace("classes", r"(.)(?=\1)|.$", "")),
            "pairs": F.col("n") - F.length(F.regexp_replace("sounds", "[vc](?=[vc])", "")),
            "turns": F.col("n") - F.length(F.regexp_replace("sounds", "v(?=c)|c(?=v)", "")),
        }
    ).withColumns(
        {
            "spread": F.expr("aggregate(values, 0D, (a, v) -> a + (v - mean) * (v - mean))"),
            "lagged": F.expr(
                "aggregate(zip_with(values, slice(values, 2, greatest(n - 1, 0)), "
                "(v, w) -> (v - mean) * (w - mean)), 0D, (a, x) -> a + coalesce(x, 0D))"
            ),
        }
    )
    n, k, places = F.col("n"), F.col("k"), F.greatest(F.col("n") - 1, F.lit(1))
    distance = k / n * F.col("squares") - n
    uniform = (distance - (k - 1) - n * excess) / F.sqrt(2 * (k - 1) + 4 * n * excess)
    moved = (F.col("moves") - places * changes - 0.5) / F.sqrt(places * changes * (1 - changes))
    correlation = F.when(F.col("spread") > 0, F.col("lagged") / F.col("spread")).otherwise(1.0)
    correlated = (correlation - serial) * F.sqrt(n)
    pairs = F.col("pairs")
    spoken = (pairs * syllables - F.col("turns") - 0.5) / F.sqrt(pairs * syllables * (1 - syllables))
    spoken = F.when(pairs > 0, spoken).otherwise(0.0)
    total = (
        F.when(F.col("encoding").isin("hex", "HEX"), (moved - uniform - correlated) / 3**0.5)
        .when(F.col("encoding").isin(*ONE_CASE), (spoken - uniform) / 2**0.5)
        .when(F.col("encoding").isin(*MIXED), (moved - uniform - correlated + spoken) / 2)
        .otherwise(
            (F.least(moved, F.lit(2.0)) - uniform + F.least(-correlated, F.lit(2.0)) + 1.5 * spoken)
            / (3 + 1.5**2) ** 0.5
        )
    )
    z = F.greatest(F.lit(-8.0), F.least(F.lit(30.0), total))
    tested = (n > 1) & (F.col("encoding") != "decimal")
    evidence = F.when(tested, -F.log10(_upper_tail(z))).otherwise(0.0)
    return df.withColumn("evidence", evidence).drop(
        "symbols", "alphabet", "k", "chars", "classes", "values", "squares", "mean", "moves",
        "spread", "lagged", "sounds", "pairs", "turns",
    )


def discoveries(tested: DataFrame, rate: float = 0.01, token: str = "run") -> DataFrame:
    """Rows of ``tested`` that the false-discovery control accepts at ``rate``.

    Evidence is compared in steps of a twentieth, at the step's weakest value. Rows with the same
    ``token`` are one test.
    """
    stratum = ["encoding", "doubling"]
    tested = tested.withColumns(
        {
            "doubling": F.floor(F.log2(F.greatest("n", F.lit(1)))).cast("int"),
            "step": F.floor(F.col("evidence") * 20).cast("int"),
        }
    )
    distinct = tested.select(*stratum, "step", token).distinct()
    counts = distinct.groupBy(*stratum, "step").agg(F.count(F.lit(1)).alias("runs"))
    found = F.sum("runs").over(Window.partitionBy(*stratum).orderBy(F.desc("step")))
    all_runs = F.sum("runs").over(Window.partitionBy(*stratum))
    limits = (
        counts.withColumns({"found": found, "all": all_runs})
        .where(F.pow(F.lit(10.0), -F.col("step") / 20) <= rate * F.col("found") / F.col("all"))
        .groupBy(*stratum)
        .agg(F.min("step").alias("least"))
    )
    # A row for each encoding and doubling of the length.
    return (
        tested.join(F.broadcast(limits), stratum)
        .where(F.col("step") >= F.col("least"))
        .drop("doubling", "step", "least")
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_run: int = 20,
    rate: float = 0.01,
    row_col: str | None = None,
) -> DataFrame:
    """One row for each input row: ``row, id, base, spans``.

    ``base`` are the spans with a pattern, ``spans`` these and the random runs outside them; both
    are arrays of ``start, order, end, kind`` in code points, by start and then kind. A null or
    empty text has none, rows given twice are scanned twice, an empty table gives no rows.
    ``row_col`` names a key of the rows if there is one; else they are numbered.
    """
    key = F.col(row_col) if row_col else F.monotonically_increasing_id()
    df = docs.select(
        key.alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    run = rf"[A-Za-z0-9+/_=-]{{{least_run},}}"
    text = F.col("text")
    for order, (kind, pattern) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX, run))):
        matches = f"{kind}_match"
        df = df.withColumn(matches, F.regexp_extract_all(text, F.lit(pattern), 0))
        df = df.withColumn(kind, _spans(text, F.col(matches), pattern, kind, order))
    long_enough = _let(
        F.regexp_extract_all(text, F.lit(ASSIGN), 2),
        lambda values: F.filter("assign", lambda _, i: F.length(values[i]) >= 8),
    )
    assign = F.when(F.size("assign") > 0, long_enough).otherwise(F.col("assign"))
    df = df.withColumn("base", F.array_sort(F.concat(assign, "access", "hex")))

    def outside(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))

    paired = F.zip_with("random", "random_match", lambda s, m: F.struct(s.alias("span"), m.alias("run")))
    scanned = materialise(
        df.withColumn("runs", F.filter(paired, lambda p: outside(p["span"]))).select(
            "row", "id", "base", "runs"
        ),
        "secret-spans",
    )
    runs = scanned.select("row", F.inline("runs"))
    # Written, since a filter on the evidence would compute it again for each of its conditions.
    tested = materialise(
        randomness(runs, "run").select("row", "span", "run", "encoding", "n", "evidence"),
        "tested-runs",
    )
    found = discoveries(tested, rate)
    more = found.groupBy("row").agg(F.collect_list("span").alias("more"))
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "more"))
    )
    return scanned.join(more, "row", "left").select("row", "id", "base", spans.alias("spans"))


def described(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def counts_and_digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(described("base"), 256).alias("base_sha256"),
        described("spans").alias("spans"),
    )


def redact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False
) -> DataFrame:
    """``docs`` with every secret in the text replaced by its kind in brackets.

    Spans that overlap are replaced as one, under the kind of the first. Rows without a secret
    stay as they are, null texts included; no row is dropped. ``stored`` spares writing the
    input where it comes straight from Parquet files.
    """
    key = fresh(docs, "secret_row")
    spans = fresh(docs, "secret_spans")
    keyed = numbered(docs, key, stored)
    found = find_secrets(keyed, id_col, text_col, row_col=key).where(F.size("spans") > 0)
    found = found.select(F.col("row").alias(key), F.col("spans").alias(spans))
    text = F.col(text_col)

    def replaced(ends: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            # The furthest end before; a span that starts there or later is a new hole.
            before = F.when(i == 0, F.lit(0)).otherwise(ends[i - 1])
            kept = F.substring(
                text, (before + 1).cast("int"), (s["start"] - before).cast("int")
            )
            hole = F.concat(kept, F.lit("["), s["kind"], F.lit("]"))
            return F.when(s["start"] >= before, hole).otherwise("")

        rest = F.substring(text, (F.array_max(ends) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    ends = _running(F.transform(spans, lambda s: s["end"].cast("int")), lambda a, x: F.greatest(a, x))
    joined = keyed.join(found, key, "left")
    text = F.when(F.col(spans).isNull(), text).otherwise(_let(ends, replaced))
    return joined.withColumn(text_col, text).select(*docs.columns)
