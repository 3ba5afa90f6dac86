"""Document fingerprints by consistent weighted sampling, with built-in functions only.

The terms of a text are its pairs of neighbouring words (the last word alone), lower-cased and
hashed to 64 bits; a term's weight is how often it occurs.  For each term and each
of ``SAMPLES`` draws, r and c are from Gamma(2, 1) and b from the uniform distribution,
all made from hashes of the term.  A term of weight w then has

    t = floor(ln w / r + b),    ln a = ln c - r (t - b + 1)

and the term with the lowest a, together with its t, is the draw's sample.  Two texts have the
same sample with a probability of their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones.

r and b come from two independent Exp(1) numbers, s = -ln x and u = -ln y for uniform x and y: r = s + u is from
Gamma(2, 1), and b = s / r is uniform and independent of it.  So t = floor((ln w + s) / r) and
a = c exp(s - r (t + 1)) = c y exp(-r t); for a term that occurs once, as most do, t = 0 and a = c y.

c and y come from two more, e = -ln(1 - p) and f = -ln q: c = e + f is from Gamma(2, 1), and y = e / c is uniform and
independent of it.  So for a term that occurs once a = e, which grows with p: the order of 1 - exp(-a) is that of a,
and for most terms it is the uniform p, bits of a hash, without a logarithm.

A term that occurs more often becomes a row for each draw, so that its formula stands once in the plan, over the
number of the draw, and not 64 times: the driver plans and compiles each copy again and again.

Documents are dealt by ranges of their ids, once, with the text; the next document, the edited text and
all sums by term are found inside a range.  The first document of each range is also dealt to the one before.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from turnout.llm.tables import checked_broadcast, stored

SAMPLES = 64
RANGE_BYTES = 4 << 20
MOST_TASKS = 20_000
CUTS = 64  # ranges of ids cut at quantiles; each is cut again into equal widths
SPACE = "[\\\\x20\\\\x09-\\\\x0D]+"


def _draw(k: int | str) -> tuple[str, str, str, str]:
    """SQL for 31 bits of a hash of the ``term``, for e whose 1 - exp(-e) they are, and for f and s.

    ``k`` is a number or a column of them.
    """
    first, second = (f"2 * {k}", f"2 * {k} + 1") if isinstance(k, str) else (2 * k, 2 * k + 1)
    bits, other = f"xxhash64(term, {first})", f"xxhash64(term, {second})"
    return (
        f"shiftrightunsigned({bits}, 33)",
        f"(-log1p(-(shiftrightunsigned({bits}, 33) + 0.5D) / 2147483648D))",
        f"(-ln((({bits} & 4294967295L) + 0.5D) / 4294967296D))",
        f"(-ln((shiftrightunsigned({other}, 32) + 0.5D) / 4294967296D))",
    )


def draws(spark: SparkSession, terms: int = 1 << 16) -> DataFrame:
    """``term`` and the arrays ``r``, ``lc`` and ``b`` for terms from 0 on, to look at their distribution."""
    def named(k):
        _, e, f, s = _draw(k)
        r = f"({s} + log1p({f} / {e}))"
        return r, f"ln({e} + {f})", f"({s} / {r})"

    parts = zip(*map(named, range(SAMPLES)), strict=True)
    return spark.range(terms).selectExpr("id as term").selectExpr(
        "term", *[f"array({', '.join(part)}) as {name}" for part, name in zip(parts, ("r", "lc", "b"), strict=True)]
    )


def _range_number(bounds: list[int], splits: int) -> str:
    """SQL for the number of the range of ``doc_id``, ascending with it; ids that are null come first."""
    def inside(i):
        lo, hi = bounds[i], bounds[i + 1]
        width = max(float(hi) - float(lo), 1.0)
        part = f"floor((double(doc_id) - {float(lo)!r}D) / {width!r}D * {splits})"
        return f"{i * splits} + greatest(0, least({splits - 1}, int({part})))"

    def cut(first, last):
        if last - first == 1:
            return inside(first)
        middle = (first + last) // 2
        return f"if(doc_id < {bounds[middle]}L, {cut(first, middle)}, {cut(middle, last)})"

    return f"if(doc_id is null, 0, {cut(0, len(bounds) - 1)})"


def _ranged(texts: DataFrame) -> DataFrame:
    """Rows with ``part``, their range, each range ending with the row that follows it (``guest``)."""
    fractions = [i / CUTS for i in range(CUTS + 1)]
    size, bounds = texts.agg(
        F.sum(F.octet_length("text")), F.percentile_approx("doc_id", fractions, 10_000)
    ).first()
    bounds = sorted(set(bounds or [0]))
    if len(bounds) == 1:
        bounds.append(bounds[0] + 1)
    wanted = -(-(size or 0) // RANGE_BYTES)
    splits = max(1, -(-wanted // (len(bounds) - 1)))
    placed = texts.withColumn("part", F.expr(_range_number(bounds, splits)))
    # One row a range: its first id, and the range before it; the very first follows the last.
    order = Window.orderBy("part")
    firsts = stored(
        placed.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("f"))
        .select(
            "part", F.col("f.doc_id").alias("first_id"), F.lag("part").over(order).alias("before"),
            F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"),
        )
    )
    home = "struct(part, false as guest, 0 as turn)"
    away = "struct(coalesce(before, last) as part, true as guest, int(before is null) as turn)"
    copies = f"if(doc_id <=> first_id, array({home}, {away}), array({home}))"
    dealt = placed.join(checked_broadcast(firsts), "part").select(
        "doc_id", "text", F.explode(F.expr(copies)).alias("p")
    ).select("p.part", "p.guest", "p.turn", "doc_id", "text")
    # With the filter that a join on ``part`` would add on one side only, all readers share one shuffle.
    ranges = (len(bounds) - 1) * splits
    return dealt.where("part is not null").repartition(min(MOST_TASKS, ranges), "part")


def _with_edited(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("part").orderBy("turn", F.asc_nulls_first("doc_id"), "text")
    half = "(char_length(text) div 2)"
    return rows.withColumns({
        "row": F.row_number().over(order), "next_text": F.lead("text").over(order),
    }).withColumn("edited", F.expr(f"""
        concat(substring(text, 1, int(char_length(text) - {half})), substring(next_text, 1, int({half})))
    """))


def _samples(rows: DataFrame) -> DataFrame:
    """``own`` and ``changed``, arrays of samples, for each ``part`` and ``row`` whose text has a term."""
    words = f"split(lower(t), '{SPACE}')"
    counted = (
        rows.select("part", "row", F.explode(F.expr(
            "if(guest, array(struct(0 as side, text as t)), "
            "array(struct(0 as side, text as t), struct(1 as side, edited as t)))"
        )).alias("s"))
        .select("part", (F.col("row").cast("long") * 2 + F.col("s.side")).alias("which"), "s.t")
        .select("part", "which", F.expr(words).alias("w"))
        .select("part", "which", F.expr("inline(arrays_zip(w, slice(w, 2, greatest(size(w) - 1, 0))))"))
        .toDF("part", "which", "a", "b").where("a <> ''")
        .select("part", "which", F.expr("xxhash64(a, coalesce(b, ''))").alias("term"))
        .groupBy("part", "which", "term").agg(F.count("*").alias("n"))
        .select("part", "which", "term", "n", F.explode(F.expr(
            f"if(n = 1, array(int(null)), array({', '.join(map(str, range(SAMPLES)))}))"
        )).alias("k"))
    )

    # The order in the upper bits, 31 of 1 - exp(-a); below it a number for term and t.
    _, *drawn = _draw("k")
    often = (
        counted.select("*", *[F.expr(f"if(k is null, null, {x})").alias(name) for x, name in zip(drawn, "efs", strict=True)])
        .select("part", "which", "term", "n", "k", "e", "s", F.expr("s + log1p(f / e)").alias("r"))
        .select("part", "which", "term", "k", "e", "r", F.expr("floor((ln(n) + s) / r)").alias("t"))
        .select("part", "which", "term", "k", F.expr("""
            shiftleft(least(2147483647L, bigint(-expm1(-e * exp(-r * t)) * 2147483648D)), 32)
            | ((term ^ ((t & 65535L) * 2654435761L)) & 4294967295L)
        """).alias("own"))
    )

    def lowest(k):
        once = f"shiftleft({_draw(k)[0]}, 32) | (term & 4294967295L)"
        return F.expr(f"min(if(k is null, {once}, if(k = {k}, own, null)))").alias(f"m{k}")

    ids = ", ".join(f"m{k} & 4294967295L" for k in range(SAMPLES))
    sampled = often.groupBy("part", "which").agg(*[lowest(k) for k in range(SAMPLES)]).select(
        "part", F.expr("int(which div 2)").alias("row"), F.expr("which % 2").alias("side"),
        F.expr(f"array({ids})").alias("s"),
    )
    return sampled.groupBy("part", "row").agg(
        F.max(F.when(F.col("side") == 0, F.col("s"))).alias("own"),
        F.max(F.when(F.col("side") == 1, F.col("s"))).alias("changed"),
    )


def _likeness(one: str, other: str):
    return F.expr(f"""
        if({one} is null or {other} is null, if({one} is null and {other} is null, 1D, 0D),
           size(filter(zip_with({one}, {other}, (p, q) -> p = q), e -> e)) / {SAMPLES}D)
    """)


def _text(samples: str):
    return F.expr(f"coalesce(array_join(transform({samples}, s -> lpad(lower(hex(s)), 8, '0')), ''), '')")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next``.  The edited text ends with the beginning of the next document in ascending order of
    the id in place of its own last half; after the last comes the first.  Rows without
    an id come first; rows that repeat an id follow each other by their text.  A null text counts as
    empty; a text without words has an empty fingerprint, which is like (1.0) another empty one and unlike (0.0)
    any other.  A single document is its own next.  Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = _with_edited(_ranged(texts))
    facts = rows.select(
        "part", "row", "guest", "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
    )
    order = Window.partitionBy("part").orderBy("row")
    return (
        facts.join(_samples(rows), ["part", "row"], "left")
        .withColumn("next", F.lead("own").over(order))
        .where("not guest")
        .select(
            "doc_id", "n_chars", "edited_sha256", _text("own").alias("fingerprint"),
            _text("changed").alias("edited_fingerprint"),
            _likeness("own", "changed").alias("near_edited"), _likeness("own", "next").alias("near_next"),
        )
    )
