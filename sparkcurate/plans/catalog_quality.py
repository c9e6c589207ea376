"""Queries: quality filters, de-duplication, summaries, caps and quotas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import qc, sample, stats
from ..operators.scale import attach_groups
from .curate import id_map, short_ids
from .registry import RECORDS_SQL, query, records, table

TERMS = ["MIT license", "apache license", "copyright"]
RULES = qc.QualityRules(exclude=TERMS, codes="#*%@&", max_ambiguous=0.002)
SPECIES = ["family", "species"]

_MENTIONS = " OR ".join(
    f"contains(lower(organism || chr(10) || family || chr(10) || description), '{t.lower()}')" for t in TERMS
)
_AMBIGUOUS = "(length(seq) - length(translate(upper(seq), '#*%@&', ''))) / greatest(length(seq), 1)::DOUBLE > 0.002"

CHECKED_SQL = f"""{RECORDS_SQL},
checked AS (SELECT *, ({_MENTIONS}) AS excluded, ({_AMBIGUOUS}) AS ambiguous FROM records),
med AS (SELECT family, species, median(length) AS m FROM checked WHERE NOT excluded GROUP BY ALL),
tries AS (
  SELECT c.family, c.species, m,
         count(*) FILTER (WHERE NOT excluded AND NOT ambiguous AND length >= greatest(trunc(m*0.5), 200)) AS k5,
         count(*) FILTER (WHERE NOT excluded AND NOT ambiguous AND length >= greatest(trunc(m*0.4), 200)) AS k4
  FROM checked c JOIN med USING (family, species) GROUP BY ALL),
ladder AS (
  SELECT family, species, m, CASE WHEN k5 > 0 THEN 0.5::DOUBLE WHEN k4 > 0 THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS share_used
  FROM tries),
flagged AS (
  SELECT c.*, share_used, CAST(greatest(trunc(m*share_used), 200) AS BIGINT) AS min_length_used,
         CASE WHEN excluded THEN 'excluded_organism' WHEN seq IS NULL THEN 'undefined' WHEN ambiguous THEN 'ambiguity'
              WHEN length < greatest(trunc(m*share_used), 200) THEN 'length' ELSE 'passed' END AS qc_reason
  FROM checked c LEFT JOIN ladder USING (family, species))"""


def base(spark, folder):
    """Records with the fields the exclusion terms look at."""
    return records(spark, folder).withColumn("source", F.col("family"))


def flagged(spark, folder):
    return qc.assign_reason(base(spark, folder), SPECIES, RULES)


@query("b1_term_exclusion", f"WITH {CHECKED_SQL} SELECT family, species, accession FROM checked WHERE NOT excluded")
def _b1(spark, folder):
    hit = ids.mentions_any([F.col("organism"), F.col("source"), F.col("description")], TERMS)
    return base(spark, folder).filter(~hit).select("family", "species", "accession")


@query("b2_ambiguity", f"WITH {CHECKED_SQL} SELECT accession, length FROM checked WHERE NOT ambiguous")
def _b2(spark, folder):
    bad = ids.ambiguous_fraction(F.col("seq"), "#*%@&") > 0.002
    return base(spark, folder).filter(~bad).select("accession", "length")


@query(
    "b3_undefined",
    """SELECT d.lang AS family, count(*) FILTER (WHERE l.quality IS NULL) AS n_undefined, count(*) AS n_rows
       FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL""",
)
def _b3(spark, folder):
    # a document without a label plays the record without a sequence
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    seq = F.when(F.col("quality").isNotNull(), F.col("text")).alias("seq")
    rows = docs.select(F.col("lang").alias("family"), seq, F.lit("").alias("organism"), F.lit("").alias("source"), F.lit("").alias("description"))
    checks = qc.row_checks(RULES)
    return rows.groupBy("family").agg(
        F.count_if(checks["undefined"]).alias("n_undefined"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "b4_fixed_minimum",
    f"""WITH {CHECKED_SQL} SELECT accession,
        CASE WHEN excluded THEN 'excluded_organism' WHEN ambiguous THEN 'ambiguity'
             WHEN length < 500 THEN 'length' ELSE 'passed' END AS qc_reason FROM checked""",
)
def _b4(spark, folder):
    rules = qc.QualityRules(exclude=TERMS, codes="#*%@&", max_ambiguous=0.002, min_length=500)
    return qc.assign_reason(base(spark, folder), SPECIES, rules).select("accession", "qc_reason")


@query("b5_adaptive_minimum", f"WITH {CHECKED_SQL} SELECT family, species, accession, share_used, min_length_used, qc_reason FROM flagged")
def _b5(spark, folder):
    return flagged(spark, folder).select(*SPECIES, "accession", "share_used", "min_length_used", "qc_reason")


@query(
    "b6_segment_keyword",
    """SELECT p_partkey, p_type FROM part WHERE contains(lower(p_name), lower(CASE p_type
       WHEN 'PROMO' THEN 'Ring' WHEN 'LARGE' THEN 'Bolt' ELSE 'Gear' END))""",
)
def _b6(spark, folder):
    keyword = F.when(F.col("p_type") == "PROMO", "Ring").when(F.col("p_type") == "LARGE", "Bolt").otherwise("Gear")
    return table(spark, folder, "part").filter(ids.mentions(F.col("p_name"), keyword)).select("p_partkey", "p_type")


@query(
    "b7_named_species",
    """SELECT c_custkey, name FROM (
         SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'Environmental Samples of ' || c_name
                WHEN c_nationkey < 5 THEN 'unclassified ' || c_mktsegment || ' virus' ELSE c_name END AS name FROM customer)
       WHERE NOT contains(lower(name), 'environmental samples') AND NOT contains(lower(name), 'unclassified ' || lower(c_mktsegment))""",
)
def _b7(spark, folder):
    name = (
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Environmental Samples of "), "c_name"))
        .when(F.col("c_nationkey") < 5, F.concat(F.lit("unclassified "), "c_mktsegment", F.lit(" virus")))
        .otherwise(F.col("c_name"))
    )
    named = table(spark, folder, "customer").withColumn("name", name)
    return named.filter(ids.named_species(F.col("name"), F.col("c_mktsegment"))).select("c_custkey", "name")


@query(
    "b8_record_selection",
    """SELECT p_partkey, p_type, p_name FROM part WHERE p_brand <> 'Brand#9' AND NOT contains(lower(p_type), 'promo')
       AND (contains(lower(p_name), 'ring') OR lower(p_brand) = 'ring')""",
)
def _b8(spark, folder):
    want = ids.record_selection(
        "protein", "ring", title=F.col("p_name"), gene=F.col("p_brand"), protein_name=F.col("p_name"),
        organism=F.col("p_type"), reference=F.col("p_size") > 25, patent=F.col("p_brand") == "Brand#9", exclude=["promo"],
    )
    return table(spark, folder, "part").filter(want).select("p_partkey", "p_type", "p_name")


@query(
    "b9_marker_selection",
    """SELECT p_partkey, p_name FROM part WHERE p_size > 25 AND p_brand <> 'Brand#9'
       AND (contains(lower(p_name), 'small ring') OR contains(lower(p_name), lower(p_type)) OR contains(lower(p_name), 'bolt'))""",
)
def _b9(spark, folder):
    names = F.array(F.lit("Small Ring"), F.col("p_type"), F.lit("bolt"))
    want = ids.marker_selection(
        names, protein_name=F.col("p_name"), organism=F.col("p_type"), reference=F.col("p_size") > 25,
        patent=F.col("p_brand") == "Brand#9", reference_only=True,
    )
    return table(spark, folder, "part").filter(want).select("p_partkey", "p_name")


@query("b10_protected_ids", f"WITH {RECORDS_SQL} SELECT accession, protected AS is_protected FROM records")
def _b10(spark, folder):
    return records(spark, folder).select("accession", ids.is_protected_id(F.col("accession")).alias("is_protected"))


@query(
    "b12_size_gate",
    f"""WITH {CHECKED_SQL}, good AS (SELECT * FROM flagged WHERE qc_reason = 'passed'),
        n AS (SELECT family, species, count(*) AS n FROM good GROUP BY ALL)
        SELECT family, species, n, CASE WHEN n < 4 THEN 'too few rows after QC' ELSE 'OK' END AS status FROM n""",
)
def _b12(spark, folder):
    good = qc.passed(flagged(spark, folder))
    skipped = qc.small_groups(good, SPECIES, "too few rows after QC")
    kept = qc.without_groups(good, skipped, SPECIES).groupBy(*SPECIES).agg(F.count(F.lit(1)).alias("n"))
    return skipped.withColumnRenamed("reason", "status").unionByName(kept.withColumn("status", F.lit("OK")))


@query(
    "b14_placeholders",
    "SELECT doc_id, CASE WHEN trim(lang) IN ('', 'unknown') THEN 'absent' ELSE lang END AS lang_or_absent FROM (SELECT doc_id, CASE WHEN n_chars < 1000 THEN 'unknown' WHEN n_chars > 5000 THEN '  ' ELSE lang END AS lang FROM documents)",
)
def _b14(spark, folder):
    masked = F.when(F.col("n_chars") < 1000, "unknown").when(F.col("n_chars") > 5000, "  ").otherwise(F.col("lang"))
    return table(spark, folder, "documents").select("doc_id", F.coalesce(ids.known(masked), F.lit("absent")).alias("lang_or_absent"))


@query(
    "c1_metadata_join",
    f"WITH {RECORDS_SQL} SELECT accession, quality, toxic FROM records JOIN labels ON ordinal = doc_id",
)
def _c1(spark, folder):
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "ordinal")
    return qc.attach_by_accession(records(spark, folder).select("accession", "ordinal"), labels, "ordinal").select("accession", "quality", "toxic")


_D1 = """SELECT family, species, CAST(sum((qc_reason='excluded_organism')::INT) AS BIGINT) AS n_excluded_organism,
  CAST(sum((qc_reason='undefined')::INT) AS BIGINT) AS n_undefined, CAST(sum((qc_reason='ambiguity')::INT) AS BIGINT) AS n_excluded_ambiguity,
  CAST(sum((qc_reason='length')::INT) AS BIGINT) AS n_excluded_length, CAST(sum((qc_reason='passed')::INT) AS BIGINT) AS n_passed"""


@query(
    "d1_qc_breakdown",
    f"""WITH {CHECKED_SQL}, per AS ({_D1}, max(share_used) AS s FROM flagged GROUP BY family, species)
        SELECT family, species, n_excluded_organism, n_undefined, n_excluded_ambiguity, n_excluded_length, n_passed,
               CAST((s < 0.5 AND n_passed > 0)::INT AS BIGINT) AS n_relaxed FROM per
        UNION ALL
        SELECT family, NULL, CAST(sum(n_excluded_organism) AS BIGINT), CAST(sum(n_undefined) AS BIGINT), CAST(sum(n_excluded_ambiguity) AS BIGINT),
               CAST(sum(n_excluded_length) AS BIGINT), CAST(sum(n_passed) AS BIGINT),
               CAST(sum((s < 0.5 AND n_passed > 0)::INT) AS BIGINT) FROM per GROUP BY family""",
)
def _d1(spark, folder):
    return qc.breakdown(flagged(spark, folder))


def exclusive_sql(source: str, keys: str, value: str) -> str:
    """The exclusive quartile rule on sorted lists."""

    def q(i):
        j = f"greatest(1, least(n - 1, ({i} * (n + 1)) // 4))"
        return f"(v[{j}] * (4 - ({i} * (n + 1) - {j} * 4)) + v[{j} + 1] * ({i} * (n + 1) - {j} * 4)) / 4.0::DOUBLE"

    return f"""sorted AS (SELECT {keys}, list_sort(list({value})) AS v, count({value}) AS n, median({value})::DOUBLE AS mid, avg({value}) AS mean
                 FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL),
      quart AS (SELECT {keys}, n, v, mean, CASE WHEN n < 3 THEN mid ELSE {q(1)} END AS q1, CASE WHEN n < 3 THEN mid ELSE {q(2)} END AS q2,
                 CASE WHEN n < 3 THEN mid ELSE {q(3)} END AS q3 FROM sorted)"""


@query(
    "d2_length_summary",
    f"""WITH {CHECKED_SQL}, good AS (SELECT * FROM flagged WHERE qc_reason = 'passed'),
        {exclusive_sql("good", "family, species", "length")}
        SELECT family, species, n, v[1] AS min, round_even(q1, 1)::DOUBLE AS q1, round_even(q2, 1)::DOUBLE AS median,
               round_even(mean, 1)::DOUBLE AS mean, round_even(q3, 1)::DOUBLE AS q3, v[-1] AS max, round_even(q3 - q1, 1)::DOUBLE AS iqr
        FROM quart""",
)
def _d2(spark, folder):
    return stats.five_number_summary(qc.passed(flagged(spark, folder)), SPECIES, "length")


@query(
    "d13_length_histogram",
    f"""WITH {RECORDS_SQL}, r AS (SELECT family, min(length)::DOUBLE AS lo, max(length)::DOUBLE AS hi,
          least(40, greatest(5, count(*) // 3)) AS bins FROM records GROUP BY family)
        SELECT family, CAST(least(floor((length - lo) / ((hi - lo) / bins)) + 1, bins) AS INTEGER) AS bin, count(*) AS n_rows
        FROM records JOIN r USING (family) GROUP BY ALL""",
)
def _d13(spark, folder):
    return stats.histogram(records(spark, folder), "family", "length")


@query(
    "d13_support_histogram",
    """SELECT o_orderstatus AS tree_id, CAST(least(floor(s / 5.0::DOUBLE) + 1, 20) AS INTEGER) AS bin, count(*) AS n_rows
       FROM (SELECT o_orderstatus, floor(o_totalprice / 5000.0::DOUBLE) AS s FROM orders) WHERE s BETWEEN 0 AND 100 GROUP BY ALL""",
)
def _d13b(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("tree_id"), F.floor(F.col("o_totalprice") / 5000.0).cast("double").alias("s")
    )
    return stats.histogram(rows, "tree_id", "s", bins=20, low=0, high=100)


@query(
    "d14_box_rows",
    f"""WITH {CHECKED_SQL} SELECT family, species, count(*) AS n, min(length) AS low,
          round_even(quantile_cont(length, 0.25), 4)::DOUBLE AS q1, round_even(quantile_cont(length, 0.5), 4)::DOUBLE AS median,
          round_even(quantile_cont(length, 0.75), 4)::DOUBLE AS q3, max(length) AS high
        FROM checked WHERE NOT excluded AND NOT ambiguous GROUP BY ALL HAVING count(*) >= 5""",
)
def _d14(spark, folder):
    rows = flagged(spark, folder).filter(F.col("qc_reason").isin("passed", "length"))
    return stats.box_rows(rows, SPECIES, "length")


@query(
    "e1_keep_first",
    "SELECT lang, min(doc_id) AS doc_id FROM documents GROUP BY lang, text",
)
def _e1(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "text", "doc_id")
    keyed = docs.select("lang", F.md5("text").alias("h"), F.length("text").alias("l"), "doc_id")
    return qc.deduplicate(keyed, ["lang", "h", "l"], "doc_id").select("lang", "doc_id")


@query(
    "e1_removed_counts",
    "SELECT lang, count(*) AS n_rows, count(*) - count(DISTINCT text) AS n_removed FROM documents GROUP BY lang",
)
def _e1b(spark, folder):
    docs = table(spark, folder, "documents").select("lang", F.md5("text").alias("h"))
    return qc.duplicate_counts(docs, ["lang"], "h")


@query(
    "e2_protected_first_cap",
    f"""WITH {RECORDS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY ordinal) AS rn,
          count(*) FILTER (WHERE protected) OVER (PARTITION BY species) AS np FROM records),
        o AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY ordinal) AS k FROM r WHERE rn <= 20 AND NOT protected)
        SELECT species, accession FROM records WHERE protected
        UNION ALL SELECT species, accession FROM o WHERE k <= greatest(0, 20 - np)""",
)
def _e2(spark, folder):
    rows = records(spark, folder).select("species", "accession", "ordinal", "protected")
    return sample.protected_first_cap(rows, "species", 20).select("species", "accession")


_E4 = f"""{RECORDS_SQL}, m AS (SELECT *, median(length) OVER (PARTITION BY family) AS median_length,
          count(*) OVER (PARTITION BY family) AS n FROM records),
        f AS (SELECT *, CASE WHEN n < 2 THEN NULL WHEN length > median_length * 3.0::DOUBLE THEN 'long'
              WHEN length < median_length * 0.333::DOUBLE THEN 'short' END AS side FROM m)"""


@query(
    "e4_length_outliers",
    f"WITH {_E4} SELECT family, accession FROM f WHERE side IS NULL OR protected",
)
def _e4(spark, folder):
    rows = records(spark, folder).select("family", "accession", "length", "protected")
    return qc.drop_length_outliers(qc.flag_length_outliers(rows, "family", low=0.333)).select("family", "accession")


@query(
    "c8_protected_outlier_counts",
    f"""WITH {_E4} SELECT family, max(median_length)::DOUBLE AS median_length, count(*) AS n,
        count(*) FILTER (WHERE side = 'long' AND NOT protected) AS n_long, count(*) FILTER (WHERE side = 'short' AND NOT protected) AS n_short,
        count(*) FILTER (WHERE side IS NOT NULL AND protected) AS n_protected FROM f GROUP BY family""",
)
def _c8(spark, folder):
    rows = records(spark, folder).select("family", "accession", "length", "protected")
    return qc.outlier_counts(qc.flag_length_outliers(rows, "family", low=0.333), "family")


@query(
    "e8_short_ids",
    f"""WITH {RECORDS_SQL} SELECT accession,
        (CASE WHEN length(regexp_replace(upper(family), '[^A-Z]|[AEIOU]', '', 'g')) >= 4 THEN substr(regexp_replace(upper(family), '[^A-Z]|[AEIOU]', '', 'g'), 1, 4)
              ELSE upper(substr(family, 1, 4)) END) || '_' ||
        lpad(CAST(row_number() OVER (PARTITION BY family ORDER BY species, ordinal) AS VARCHAR), 6, '0') AS short_id FROM records""",
)
def _e8(spark, folder):
    rows = records(spark, folder).select("family", "species", "ordinal", "accession")
    return short_ids(rows).select("accession", "short_id")


@query(
    "a6_id_map",
    f"""WITH {RECORDS_SQL}, s AS (SELECT *, upper(substr(family, 1, 4)) || '_' ||
        lpad(CAST(row_number() OVER (PARTITION BY family ORDER BY species, ordinal) AS VARCHAR), 6, '0') AS short_id FROM records)
        SELECT family, short_id, accession, species || '|' || strain || '|' || accession AS display_name FROM s""",
)
def _a6(spark, folder):
    rows = records(spark, folder).select("family", "species", "ordinal", "accession", "strain", "host")
    return id_map(short_ids(rows))


def quota_sql(source: str, family: str, species: str, target: int, strict: bool) -> str:
    """Quotas per species; removal turns are listed and counted."""
    passes = "q0 - 1" if strict else "least(q0 - 1, 1)"
    return f"""cnt AS (SELECT {family}, {species}, count(*) AS n_reps FROM {source} GROUP BY ALL),
      tot AS (SELECT *, sum(n_reps) OVER (PARTITION BY {family})::DOUBLE AS total, count(*) OVER (PARTITION BY {family}) AS ns,
                row_number() OVER (PARTITION BY {family} ORDER BY n_reps DESC, {species}) AS place FROM cnt),
      raw AS (SELECT *, greatest(1, CAST(round_even(n_reps / total * {target}, 0) AS INTEGER)) AS q0,
                n_reps / total * {target} - floor(n_reps / total * {target}) AS frac FROM tot),
      ord AS (SELECT *, {target} - sum(q0) OVER (PARTITION BY {family}) AS diff,
                row_number() OVER (PARTITION BY {family} ORDER BY frac DESC, {species}) AS o FROM raw),
      turns AS (SELECT {family}, {species}, diff, row_number() OVER (PARTITION BY {family} ORDER BY p, o) AS turn
                FROM (SELECT *, unnest(range(1, {passes} + 1)) AS p FROM ord WHERE total > {target} AND ns <= {target} AND diff < 0 AND q0 > 1)),
      given AS (SELECT {family}, {species}, count(*) AS g FROM turns WHERE turn <= -diff GROUP BY ALL),
      plan AS (SELECT o.{family}, o.{species}, n_reps, CAST(CASE WHEN total <= {target} THEN n_reps
                WHEN ns > {target} THEN (place <= {target})::INT
                ELSE q0 + (diff > 0 AND o <= diff)::INT - coalesce(g, 0) END AS BIGINT) AS quota
               FROM ord o LEFT JOIN given USING ({family}, {species}))"""


for _mode in ("strict", "compat"):

    @query(
        f"h4_quotas_{_mode}",
        f"WITH {quota_sql('part', 'p_type', 'p_brand', 40, _mode == 'strict')} SELECT p_type, p_brand, n_reps, quota FROM plan",
    )
    def _quotas(spark, folder, mode=_mode):
        counts = sample.species_counts(table(spark, folder, "part"), ["p_type"], "p_brand")
        return sample.quotas(counts, "p_type", "p_brand", 40, mode)


@query(
    "e9_quota_sample",
    f"""WITH {RECORDS_SQL}, {quota_sql('records', 'family', 'species', 60, True)},
        rk AS (SELECT *, row_number() OVER (PARTITION BY family, species ORDER BY protected DESC, md5('42|' || accession), accession) AS k FROM records)
        SELECT family, species, accession, protected FROM rk JOIN plan USING (family, species) WHERE k <= quota""",
)
def _e9(spark, folder):
    rows = records(spark, folder).select("family", "species", "accession", "protected")
    return sample.quota_sample(rows, "family", "species", 60)


@query(
    "f1_top_species",
    """WITH c AS (SELECT p_type, p_brand, count(*) AS n_reps FROM part GROUP BY ALL)
       SELECT p_type, p_brand, n_reps, CAST(k AS INTEGER) AS species_rank FROM (SELECT *,
       row_number() OVER (PARTITION BY p_type ORDER BY n_reps DESC, p_brand) AS k FROM c) WHERE k <= 10""",
)
def _f1(spark, folder):
    counts = sample.species_counts(table(spark, folder, "part"), ["p_type"], "p_brand")
    return sample.top_species(counts, ["p_type"], "p_brand", 10)


@query(
    "f2_fraction_order",
    """WITH c AS (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL),
       x AS (SELECT *, n / (sum(n) OVER (PARTITION BY p_type))::DOUBLE * 40 AS x FROM c)
       SELECT p_type, p_brand, CAST(row_number() OVER (PARTITION BY p_type ORDER BY x - floor(x) DESC, p_brand) AS INTEGER) AS remainder_rank FROM x""",
)
def _f2(spark, folder):
    counts = sample.species_counts(table(spark, folder, "part"), ["p_type"], "p_brand")
    totals = counts.groupBy("p_type").agg(F.sum("n_reps").alias("__total"))
    shares = attach_groups(counts, totals, ["p_type"]).withColumn("__x", F.col("n_reps") / F.col("__total") * F.lit(40))
    return sample.fraction_order(shares, ["p_type"], "p_brand", "__x", "remainder_rank").select("p_type", "p_brand", "remainder_rank")


@query(
    "f3_union_protected_first",
    f"WITH {RECORDS_SQL} SELECT accession, 0 AS part FROM records WHERE protected UNION ALL SELECT accession, 1 FROM records WHERE NOT protected",
)
def _f3(spark, folder):
    rows = records(spark, folder).select("accession", "protected")
    first = rows.filter("protected").select("accession", F.lit(0).alias("part"))
    return first.unionByName(rows.filter(~F.col("protected")).select("accession", F.lit(1).alias("part")))


@query("f4_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _f4(spark, folder):
    return table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left_anti")


@query("f5_intersection", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def _f5(spark, folder):
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return table(spark, folder, "documents").select("doc_id").join(good, "doc_id", "left_semi")


@query("f6_distinct_keys", "SELECT DISTINCT l_partkey FROM lineitem")
def _f6(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey").distinct()
