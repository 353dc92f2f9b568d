"""Set-level operators over corpora: dedup, reconciliation, evidence, frontiers, telemetry, life cycle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import status as S
from ..functions import text as T


def first_wins(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """df with occurrence (1 for the first of its key) and kept."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("occurrence", F.row_number().over(w)).withColumn("kept", F.col("occurrence") == 1)


def duplicate_groups(df: DataFrame, key: str, id_col: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies"), F.min(id_col).alias("first_id")).where("copies > 1")


def sentence_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, sentence_index, paragraph_index, sentence_text, is_quote; no shuffle."""
    rows = docs.select("doc_id", "source", F.posexplode(T.sentences(F.col("text"))).alias("sentence_index", "s"))
    return rows.select("doc_id", "source", "sentence_index", F.col("s.paragraph_index").alias("paragraph_index"), F.col("s.text").alias("sentence_text"), T.is_quote(F.col("s.text")).alias("is_quote"))


def judged_sentences(rows: DataFrame, languages: list[str] | None = None, min_confidence: float = 0.0, allow_mixed: bool = False, **policy) -> DataFrame:
    """rows with reason (the first rule that rejects a sentence, its language last) and content_hash."""
    normal = _normalized(rows)
    reason = T.quality_reason(F.col("_normal"), quote=F.col("is_quote"), tokens=F.col("_tokens"), lower=F.col("_lower"), **policy)
    judged = normal.withColumn("reason", reason)
    if languages is not None:
        # Only a sentence that the other rules accept needs one.
        judged = judged.withColumn("_language", F.when(F.col("reason") == "accepted", L.detect(F.col("_normal"), min_confidence)))
        good = L.accepted(F.col("_language.label"), F.col("_language.confidence"), F.array(*map(F.lit, languages)), F.lit(min_confidence), F.lit(allow_mixed))
        judged = judged.withColumn("reason", F.when((F.col("reason") == "accepted") & ~good, "language").otherwise(F.col("reason"))).drop("_language")
    return judged.drop("_normal", "_lower", "_tokens").withColumn("content_hash", T.content_hash(F.col("sentence_text")))


def _normalized(rows: DataFrame) -> DataFrame:
    """rows with _normal, _lower and _tokens, columns of their own: inlined, every rule would compute them again."""
    return rows.withColumn("_normal", T.normalize_text(F.col("sentence_text"))).withColumn("_lower", F.lower("_normal")).withColumn("_tokens", T.normal_tokens(F.col("_normal")))


def _document(rows: DataFrame) -> Column:
    """doc_id in an order in which a missing one comes first."""
    kind = dict(rows.dtypes)["doc_id"]
    return F.coalesce("doc_id", F.lit("")) if kind == "string" else F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))


def deduplicated(judged: DataFrame) -> DataFrame:
    """judged with outcome: its reason, or duplicate_batch or duplicate_db, or accepted.

    A repeat within its document is a batch duplicate, a repeat of an earlier document a stored one. Rows are dealt
    by hash and document, so a sentence that many documents share is gathered by no task; its first document
    comes from a partial aggregate.
    """
    good = F.col("reason") == "accepted"
    # Keys of rejected sentences are shorter than any hash, and only deal them out. A key is never null: for one that
    # may be, the join below would judge each sentence in a filter before the exchange, and so need two exchanges.
    key = F.coalesce(F.when(good, F.unhex("content_hash")).otherwise(F.col("sentence_index").cast("string").cast("binary")), F.lit(b""))
    dealt = judged.withColumn("_key", key).withColumn("_doc", _document(judged)).repartition("_key", "_doc")
    own = F.row_number().over(Window.partitionBy("_key", "_doc").orderBy("sentence_index"))
    # All columns are named here too, so that one exchange is read twice: else each sentence would be cut and judged again.
    named = F.max(F.hash(*judged.columns))
    first = dealt.groupBy("_key").agg(F.min("_doc").alias("_d"), named.alias("_any")).select(F.col("_key").alias("_k"), F.when(F.col("_any").isNotNull(), F.col("_d")).alias("_d"))
    ranked = dealt.withColumn("_own", own).join(first, (F.col("_key") == F.col("_k")) & (F.col("_doc") == F.col("_d")), "left")
    outcome = F.when(~good, F.col("reason")).when(F.col("_own") > 1, "duplicate_batch").when(F.col("_k").isNull(), "duplicate_db").otherwise("accepted")
    return ranked.withColumn("outcome", outcome).drop("_key", "_doc", "_own", "_k", "_d")


def sentence_outcomes(rows: DataFrame, **policy) -> DataFrame:
    """Each sentence's outcome: its quality reason, or language, duplicate_batch or duplicate_db, or accepted."""
    return deduplicated(judged_sentences(rows, **policy))


def outcome_counts(judged: DataFrame) -> DataFrame:
    """outcome and n of judged sentences, as deduplicated tells outcomes; no sentence is sorted or joined.

    Of a hash's n sentences in d documents one is accepted, d - 1 are known from another document and n - d repeat
    one of their own document.
    """
    good = F.col("reason") == "accepted"
    own = judged.groupBy("reason", F.when(good, F.unhex("content_hash")).alias("_key"), F.when(good, _document(judged)).alias("_doc")).agg(F.count("*").alias("n"))
    each = own.groupBy("reason", "_key").agg(F.sum("n").alias("n"), F.count("*").alias("d"))
    part = lambda o, n: F.struct(o.alias("outcome"), n.alias("n"))
    parts = F.when(good, F.array(part(F.lit("accepted"), F.lit(1).cast("bigint")), part(F.lit("duplicate_db"), F.col("d") - 1), part(F.lit("duplicate_batch"), F.col("n") - F.col("d")))).otherwise(F.array(part(F.col("reason"), F.col("n"))))
    return each.select(F.inline(parts)).where("n > 0").groupBy("outcome").agg(F.sum("n").alias("n"))


def policy_totals(rows: DataFrame, profiles: dict[str, tuple]) -> DataFrame:
    """profile, candidates, accepted and rejected; profiles: least and most tokens, quotes, headlines, least score.

    Sentences are cut, normalised and judged once, by the rules without a limit; a profile rejects more by its
    limits. Of the sentences of one hash that a profile lets through the first is accepted, so their number is that of
    the hashes, and a row for each hash holds every profile's answer.
    """
    normal = _normalized(rows.select("is_quote", "sentence_text"))
    bare = T.quality_reason(F.col("_normal"), low=0, high=(1 << 31) - 1, quotes=True, headlines=True, tokens=F.col("_tokens"), lower=F.col("_lower")) == "accepted"
    n = F.col("_tokens")
    fits = [(n >= low) & (n <= high) & (F.lit(quotes) | ~F.coalesce("is_quote", F.lit(False))) & F.lit(least <= 1.0) for low, high, quotes, _, least in profiles.values()]
    flags = [f"_p{i}" for i in range(len(fits))]
    wanted = normal.select("sentence_text", F.when(bare, F.array(*fits)).otherwise(F.array(*[F.lit(False)] * len(fits))).alias("_fits"))
    key = F.when(F.array_contains("_fits", True), F.unhex(T.content_hash(F.col("sentence_text"))))
    each = wanted.select(key.alias("_key"), *[F.col("_fits")[i].alias(f) for i, f in enumerate(flags)]).groupBy("_key").agg(F.count("*").alias("n"), *[F.max(f).cast("bigint").alias(f) for f in flags])
    totals = each.agg(F.sum("n").alias("candidates"), *[F.sum(f).alias(f) for f in flags]).where("candidates > 0")
    rows = F.inline(F.array(*[F.struct(F.lit(p).alias("profile"), "candidates", F.col(f).alias("accepted"), (F.col("candidates") - F.col(f)).alias("rejected")) for p, f in zip(profiles, flags, strict=True)]))
    return totals.select(rows)


def reconcile(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Each candidate's outcome; candidates: ord, method, url, scope and, if dates gate, date_reason; stored: url.

    Seen = invalid + duplicates + unique, and unique = rejected + stored + queued.
    """
    invalid = (F.col("url") == "") | (F.col("scope") == "unsupported_scheme")
    w = Window.partitionBy("url").orderBy("ord")
    valid = candidates.where(~invalid).withColumn("_n", F.row_number().over(w)).withColumn("_first", F.first("method").over(w))
    known = stored.select(F.col("url").alias("_stored")).distinct()
    dated = F.col("date_reason") == "date_before_cutoff" if "date_reason" in candidates.columns else F.lit(False)
    joined = valid.join(known, F.col("url") == F.col("_stored"), "left")
    outcome = F.when((F.col("_n") > 1) & (F.col("_first") != F.col("method")), "duplicate_cross_method").when(F.col("_n") > 1, "duplicate_in_run").when(F.col("scope") != "accepted", "rejected_scope").when(dated, "rejected_date_hint").when(F.col("_stored").isNotNull(), "already_stored").otherwise("queued_new")
    return joined.withColumn("outcome", outcome).select(*candidates.columns, "outcome").unionByName(candidates.where(invalid).withColumn("outcome", F.lit("invalid")))


def resolve_evidence(evidence: DataFrame, cutoff: Column, as_of: Column, allow_lastmod: bool = False) -> DataFrame:
    """item, resolved, reason, source and confidence; evidence: item, pos, source, value, confidence.

    Candidates in order of rank, confidence and position; the first acceptable one wins, else the last tells why not.
    """
    rank = F.coalesce(*[F.when(F.col("source") == s, r) for s, r in S.EVIDENCE_RANKS.items()], F.when(F.col("source").startswith("html_"), 1), F.lit(99))
    rows = evidence.where(F.lit(allow_lastmod) | (F.col("source") != "lastmod")).withColumn("reason", S.date_reason(F.col("value"), cutoff, as_of))
    place = F.struct(rank.alias("r"), (-F.col("confidence")).alias("c"), "pos")
    good = F.col("reason") == "accepted"
    picked = rows.groupBy("item").agg(F.min(F.when(good, F.struct(place.alias("p"), "value", "source", "confidence"))).alias("win"), F.max(F.struct(place.alias("p"), "reason", "source")).alias("last"))
    won = F.col("win").isNotNull()
    return picked.select("item", F.col("win.value").alias("resolved"), F.when(won, "accepted").otherwise(F.col("last.reason")).alias("reason"), F.when(won, F.col("win.source")).otherwise(F.col("last.source")).alias("source"), F.coalesce("win.confidence", F.lit(0.0)).alias("confidence"))


def disagreements(evidence: DataFrame, days: int = 30) -> DataFrame:
    """item, source and days of evidence that differs from the most trusted by more than so many days."""
    rank = F.coalesce(*[F.when(F.col("source") == s, r) for s, r in S.EVIDENCE_RANKS.items()], F.when(F.col("source").startswith("html_"), 1), F.lit(99))
    placed = evidence.where(F.col("value").isNotNull()).withColumn("_place", F.struct(rank.alias("r"), (-F.col("confidence")).alias("c"), "pos"))
    top = placed.groupBy("item").agg(F.min(F.struct("_place", "value")).alias("_top"))
    # Whole days, rounded down before the sign goes.
    apart = F.abs(F.floor((F.unix_micros(F.col("value").cast("timestamp")) - F.unix_micros(F.col("_top.value").cast("timestamp"))) / 86_400_000_000))
    rows = placed.join(top, "item").where(F.col("_place") != F.col("_top._place"))
    return rows.select("item", "source", apart.cast("bigint").alias("days")).where(F.col("days") > days)


def frontier(urls: DataFrame, limit: int) -> DataFrame:
    """The next URLs to work on: enabled sources, then depth, priority, url and id."""
    return urls.orderBy(F.desc("enabled"), "depth", F.desc("priority"), "url", "url_id").limit(limit)


def within_budget(df: DataFrame, group: str, cost: str, order: list, budget: int) -> DataFrame:
    """Rows of each group up to and with the one whose running cost reaches the budget."""
    before = F.coalesce(F.sum(cost).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_before", before).where(F.col("_before") < budget).drop("_before")


def capped_samples(df: DataFrame, keys: list[str], order: list, cap: int) -> DataFrame:
    return df.withColumn("sample", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("sample") <= cap)


def retain_runs(runs: DataFrame, source: str, order: list, keep: int) -> DataFrame:
    return runs.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("_n") <= keep).drop("_n")


def simhashes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id_col and h, the 64-bit similarity hash of each row's words: each bit is the majority over the words' hashes.

    A text's votes are summed in its own task before the shuffle. Rows that agree in id and text vote together,
    which leaves the majorities as they are. A text without words has hash 0.
    """
    one = F.lit(1).cast("bigint")
    words = df.select(id_col, F.xxhash64(text_col).alias("_text"), F.explode_outer(T.words(F.col(text_col))).alias("_word"))
    hashed = words.select(id_col, "_text", F.when(F.col("_word").isNotNull(), F.xxhash64("_word")).alias("_hash"))
    ones = [F.sum(F.shiftrightunsigned("_hash", b).bitwiseAND(one)).alias(f"_b{b}") for b in range(64)]
    votes = hashed.groupBy(id_col, "_text").agg(F.count("_hash").alias("_n"), *ones)
    bits = [F.when(2 * F.col(f"_b{b}") > F.col("_n"), F.shiftleft(one, b)).otherwise(F.lit(0).cast("bigint")) for b in range(64)]
    return votes.select(id_col, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("h"))


def near_pairs(df: DataFrame, id_col: str, text_col: str, distance: int = 3) -> DataFrame:
    """Classes of equal 64-bit similarity hashes and the pairs of different hashes within `distance` bits, by four 16-bit bands.

    Of kind member: a row for each document a, with its class (its hash). Of kind pair: two classes with their
    first ids a and b. Documents of one class are at distance 0, those of two paired classes at the pair's
    distance, so all near documents follow by joining on the classes, though no group's square is written.
    With up to three differing bits one band is equal. Rows that agree in id and text are one document. Classes
    are told apart by their hashes, so documents without an id take part.
    """
    if not 0 <= distance <= 3:
        raise ValueError("four bands find pairs of up to three differing bits")
    hashed = simhashes(df, id_col, text_col)
    none = F.lit(None)
    members = hashed.select(F.lit("member").alias("kind"), F.col(id_col).alias("a"), none.cast(df.schema[id_col].dataType).alias("b"), F.col("h").alias("class_a"), none.cast("bigint").alias("class_b"), none.cast("int").alias("distance"))
    classes = hashed.groupBy("h").agg(F.min(id_col).alias("id"))
    bands = classes.select("id", "h", F.posexplode(F.array(*[F.shiftrightunsigned("h", 16 * b).bitwiseAND(F.lit(65535).cast("bigint")) for b in range(4)])).alias("band", "v"))
    left, right = bands.alias("l"), bands.alias("r")
    # The smaller id first, a missing one last.
    place = lambda x: F.struct(F.col(f"{x}.id").isNull(), f"{x}.id", f"{x}.h")
    pairs = left.join(right, (F.col("l.band") == F.col("r.band")) & (F.col("l.v") == F.col("r.v")) & (F.col("l.h") != F.col("r.h")) & (place("l") < place("r")))
    d = T.hamming(F.col("l.h"), F.col("r.h"))
    found = pairs.where(d <= distance).select(F.lit("pair").alias("kind"), F.col("l.id").alias("a"), F.col("r.id").alias("b"), F.col("l.h").alias("class_a"), F.col("r.h").alias("class_b"), d.cast("int").alias("distance")).distinct()
    return members.unionByName(found)


def reachable(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """node and its smallest depth, breadth first up to a bound."""
    seen = roots.select("node", F.lit(0).alias("depth"))
    for d in range(1, depth + 1):
        step = edges.join(seen.where(F.col("depth") == d - 1), edges.src == F.col("node")).select(F.col("dst").alias("node"), F.lit(d).alias("depth"))
        seen = seen.unionByName(step).groupBy("node").agg(F.min("depth").alias("depth"))
    return seen
