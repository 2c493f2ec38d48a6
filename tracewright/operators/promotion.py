"""What stands between labelled rows and a promoted model: splits, replay tiers, field accuracy, calibration and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions.ordering import numbered
from tracewright.functions.statistics import share


def stratified_split(frame: DataFrame, id_column: str, strata: list[str], shares: dict[str, float], seed: int = 42) -> DataFrame:
    """``frame`` with ``split``: each stratum is divided in the given shares, the first taking what rounding leaves.

    Rows are ranked by a hash of seed and id within their stratum by running counts over range partitions, so a stratum
    of any size is divided exactly and no task sorts it.  Null strata are strata of their own."""
    first, *others = shares
    sizes = frame.groupBy(*strata).agg(F.count("*").alias("_size"))
    hashed = frame.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")), 256))
    ranked = numbered(hashed, strata, ["_h", id_column], "_rank")
    named = [f"_s{i}" for i in range(len(strata))]
    sized = ranked.join(sizes.select(*[F.col(s).alias(n) for s, n in zip(strata, named)], "_size"), [F.col(s).eqNullSafe(F.col(n)) for s, n in zip(strata, named)])
    split, upto = F.lit(first), F.lit(0).cast("bigint")
    conditions: list[tuple[Column, str]] = []
    for name in others:
        upto = upto + F.floor(F.col("_size") * shares[name])
        conditions.append((F.col("_rank") <= upto, name))
    for condition, name in reversed(conditions):
        split = F.when(condition, name).otherwise(split)
    return sized.withColumn("split", split).drop("_h", "_rank", "_size", *named)


def field_accuracy(frame: DataFrame, fields: list[str], attempts: str = "attempts", paired: Column | None = None) -> DataFrame:
    """(n, exact_match, first_shot_exact, pairing_rate, acc_<field>...) of rows with gold_<field> and pred_<field>; 0 over nothing.

    A match is exact if all fields are equal, nulls included; ``paired`` says whether a row's labels fit each other."""
    same = {f: F.col(f"gold_{f}").eqNullSafe(F.col(f"pred_{f}")) for f in fields}
    exact = F.lit(True)
    for s in same.values():
        exact = exact & s
    n = F.count("*")
    rate = lambda c: share(F.count_if(c), n)
    return frame.agg(n.alias("n"), rate(exact).alias("exact_match"), rate(exact & (F.col(attempts) == 1)).alias("first_shot_exact"), rate(F.lit(True) if paired is None else paired).alias("pairing_rate"), *[rate(s).alias(f"acc_{f}") for f, s in same.items()])


def attempts_histogram(frame: DataFrame, attempts: str = "attempts") -> DataFrame:
    return frame.groupBy(F.col(attempts).alias("attempts")).agg(F.count("*").alias("n"))


def child_fits(parent: Column, child: Column, children: dict[str, list[str]]) -> Column:
    """Whether a second-level label is one of its first-level label's; false for unknown parents."""
    known = F.create_map(*[x for k, v in children.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.array_contains(F.try_element_at(known, parent), child), F.lit(False))


def canonical_url(url: Column) -> Column:
    """Scheme and host in small letters, no default port, no fragment, no tracking parameters, no slash at the end."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"([?&])(?:utm_[A-Za-z]+|fbclid|gclid)=[^&]*", "$1")
    u = F.regexp_replace(F.regexp_replace(u, r"\?&+", "?"), r"&{2,}", "&")
    u = F.regexp_replace(F.regexp_replace(u, r"[?&]+$", ""), r"/+$", "")
    origin = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1)
    low = F.regexp_replace(F.lower(origin), r"^(http://.*):80$|^(https://.*):443$", "$1$2")
    return F.concat(low, F.substring(u, F.length(origin) + 1, F.length(u)))


def distinct_documents(frame: DataFrame, url: str, text: str, order: str) -> DataFrame:
    """Of documents with the same canonical url, and then of those with the same text, the first by ``order``.

    Documents without url or text are all kept. Keys are 256-bit hashes; each is aggregated before its shuffle."""
    kept = frame
    for key in (F.sha2(canonical_url(F.col(url)), 256), F.sha2(text, 256)):
        keyed = kept.withColumn("_k", key)
        firsts = keyed.where("_k is not null").groupBy("_k").agg(F.min(order).alias("_o")).select("_k", "_o")
        kept = keyed.join(firsts, "_k", "left").where(F.col("_k").isNull() | (F.col(order) == F.col("_o"))).drop("_k", "_o")
    return kept


def chunks(frame: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """``frame`` without ``text`` but with (chunk_no, start_char, chunk): pieces of ``size`` characters that overlap, with
    their places. Null and empty texts have none; the last piece is never contained in the one before it."""
    step = size - overlap
    n = F.when(F.length(text) <= size, 1).otherwise(F.ceil((F.length(text) - overlap) / step))
    rows = frame.where(F.length(text) > 0).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)))
    rows = rows.withColumn("start_char", F.col("chunk_no") * step)
    return rows.withColumn("chunk", F.substring(F.col(text), F.col("start_char") + 1, F.lit(size))).drop(text)


#: Frequent words of languages.
STOP_WORDS = {"de": "der die das und ist nicht ein eine mit von auf für den dem", "en": "the and of to is in that for with not are this on as", "es": "el la los las de que y en un una por con para no", "fr": "le la les des et est une un dans pour que qui ne pas", "pt": "o a os as de que e em um uma para com não do"}


def language(text: Column, least: int = 2) -> Column:
    """The language whose frequent words a text has most of; null under ``least`` of them; ties by name."""
    words = F.split(F.lower(text), r"[^\p{L}]+")
    hits = lambda known: -F.size(F.filter(words, lambda w: w.isin(known)))
    best = F.array_min(F.array(*[F.struct(hits(known.split()).alias("n"), F.lit(name).alias("name")) for name, known in sorted(STOP_WORDS.items())]))
    return F.when(best["n"] <= -least, best["name"])


def split_by_document(document: Column, shares: dict[str, float], seed: int = 42) -> Column:
    """The split of a document by its hash: all its pieces fall into the same one. Shares hold on average."""
    place = F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), document), 256), 1, 12), 16, 10).cast("bigint"), F.lit(10_000))
    *others, last = shares
    split, upto = F.lit(last), round(sum(shares[name] for name in others) * 10_000)
    for name in reversed(others):
        split = F.when(place < upto, name).otherwise(split)
        upto -= round(shares[name] * 10_000)
    return split


def replay_batches(frame: DataFrame, tier: str, order: str, quotas: dict[str, int]) -> DataFrame:
    """(batch_no, slot and the rows): batches with a quota of each tier, filled in order; a tier without quota (canary) is
    never trained on. Batches end with the tier that has no full quota left, so each is mixed as the quotas say.

    Tiers are numbered by running counts over range partitions."""
    chosen = numbered(frame.where(F.col(tier).isin(list(quotas))), [tier], [order], "_n")
    quota = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    placed = chosen.withColumn("batch_no", F.floor((F.col("_n") - 1) / quota[F.col(tier)])).withColumn("slot", (F.col("_n") - 1) % quota[F.col(tier)])
    full = placed.groupBy(tier).agg(F.count("*").alias("_size")).select(F.floor(F.col("_size") / quota[F.col(tier)]).alias("_full"))
    limit = full.agg(F.when(F.count("*") == len(quotas), F.min("_full")).otherwise(0).alias("_batches"))  # one row
    return placed.join(F.broadcast(limit)).where(F.col("batch_no") < F.col("_batches")).drop("_n", "_batches")


def calibration_error(frame: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """(n, ece): the expected calibration error over equal bins of confidence; a confidence of 1 falls into the last."""
    place = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1))
    per = frame.where(F.col(confidence).isNotNull()).groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.avg(confidence).alias("p"), F.avg(F.col(correct).cast("double")).alias("a"))
    return per.agg(F.sum("n").alias("n"), share(F.sum(F.col("n") * F.abs(F.col("p") - F.col("a"))), F.sum("n")).alias("ece"))


def stability_index(expected: DataFrame, actual: DataFrame, category: str, least: float = 1e-4) -> DataFrame:
    """(psi): the population stability index of two distributions over a category; shares under ``least`` count as that."""
    count = lambda f, name: f.groupBy(F.col(category).alias("c")).agg(F.count("*").alias(name))
    both = count(expected, "e").join(count(actual, "a"), "c", "full").fillna(0, ["e", "a"])
    totals = both.agg(F.sum("e").alias("te"), F.sum("a").alias("ta"))  # one row
    p = lambda n, t: F.greatest(share(F.col(n), F.col(t)), F.lit(least))
    return both.join(F.broadcast(totals)).agg(F.coalesce(F.sum((p("a", "ta") - p("e", "te")) * F.log(p("a", "ta") / p("e", "te"))), F.lit(0.0)).alias("psi"))


#: Gates of a promotion: name, whether the figure may be at most (or must be at least) the limit, and the limit.
GATES = (("json_validity", "least", 0.95), ("evidence_grounding", "least", 0.90), ("ema_norm_ratio", "most", 3.0), ("ece", "most", 0.12), ("disagreement", "most", 0.20), ("rejection_rate", "most", 0.10), ("psi", "most", 0.25))


def promotion_gates(figures: DataFrame, gates: tuple[tuple[str, str, float], ...] = GATES) -> DataFrame:
    """``figures`` (a column a gate, a row a candidate) with ``failed`` and ``promoted``; a figure that is missing fails."""
    failed = [F.when(F.coalesce((F.col(n) < limit) if way == "least" else (F.col(n) > limit), F.lit(True)), F.lit(n)) for n, way, limit in gates if n in figures.columns]
    return figures.withColumn("failed", F.array_compact(F.array(*failed))).withColumn("promoted", F.size("failed") == 0)


def newest(frame: DataFrame, key: str, order: list[str], keep: int, name: str = "back") -> DataFrame:
    """The last ``keep`` rows of each key, with their place from the end. Spark turns the limit into one within each task
    before rows are shuffled, so at most ``keep`` rows of a key and task are."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return frame.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= keep)
