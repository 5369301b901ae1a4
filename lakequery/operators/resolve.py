"""Organization resolution: exact, core and fuzzy name links, finalising, promotion, geography, adjudication and review order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.functions.rank import top_n
from lakequery.functions.text import acronym, compact, fresh, legal_core, norm_name, sequence_ratio, truthy
from lakequery.operators.joins import anti_any, blocked_pairs

COMPANY, INSTITUTION = "canonical_company_id", "openalex_institution_id"
# Fixed values of the decision rules.
EXACT, CORE, FUZZY = "NORMALIZED_EXACT", "LEGAL_CORE_EXACT", "FUZZY_CORE"
CORE_UNIQUE, CORE_AMBIGUOUS, FUZZY_LEAST, FUZZY_AUTO, MARGIN_AUTO = 0.98, 0.70, 0.88, 0.965, 0.04
ACRONYM_BONUS, COMPANY_BONUS, MOST, MOST_NOT_BEST, TOP = 0.025, 0.01, 0.97, 0.89, 5
LEAST_COMPANY_CHARS, LEAST_INSTITUTION_CHARS = 5, 4
PRODUCTION_LEAST, PROMOTE_LEAST, PRIORITY_LEAST = 0.98, 0.965, 0.93
US_STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH",
    "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR", "VI", "GU", "AS", "MP",
)
COUNTRY_CODES = {
    "AUSTRALIA": "AU", "AUSTRIA": "AT", "BELGIUM": "BE", "BERMUDA": "BM", "BRAZIL": "BR", "CANADA": "CA", "CAYMAN ISLANDS": "KY", "CHINA": "CN", "DENMARK": "DK", "FINLAND": "FI", "FRANCE": "FR", "GERMANY": "DE",
    "HONG KONG": "HK", "INDIA": "IN", "IRELAND": "IE", "ISRAEL": "IL", "ITALY": "IT", "JAPAN": "JP", "JERSEY": "JE", "LUXEMBOURG": "LU", "MEXICO": "MX", "NETHERLANDS": "NL", "NEW ZEALAND": "NZ", "NORWAY": "NO",
    "REPUBLIC OF KOREA": "KR", "SINGAPORE": "SG", "SOUTH AFRICA": "ZA", "SPAIN": "ES", "SWEDEN": "SE", "SWITZERLAND": "CH", "TAIWAN": "TW", "UNITED ARAB EMIRATES": "AE", "UNITED KINGDOM": "GB",
    "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US", "VIRGIN ISLANDS BRITISH": "VG",
}
TIER_A, TIER_B, TIER_C, TIER_D, BLOCKED = "TIER_A_STRONG", "TIER_B_GOOD", "TIER_C_MODERATE", "TIER_D_LOW", "BLOCKED_COUNTRY_CONFLICT"
PRIORITY_COLUMNS = (
    "canonical_company_id", "cik", "sec_name", "primary_ticker", "source_class", "openalex_institution_id", "openalex_name", "ror", "institution_type", "confidence", "match_method", "confidence_tier", "source_bucket",
    "sec_business_country_iso2", "openalex_country_iso2", "country_match", "country_conflict", "reclassification_decision", "reclassification_reason",
)


def pick(df: DataFrame, want: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns by the first name that is there; a missing one is a null string."""
    return df.select(*(next((F.col(c) for c in names if c in df.columns), F.lit(None).cast("string")).alias(k) for k, names in want.items()))


def institutions_of(df: DataFrame) -> DataFrame:
    return pick(df, {INSTITUTION: ("id", "institution_id"), "openalex_name": ("display_name", "name"), "ror": ("ror",), "country_code": ("country_code",), "institution_type": ("type", "institution_type")}).where(F.col(INSTITUTION).isNotNull() & F.col("openalex_name").isNotNull())


def companies_of(df: DataFrame) -> DataFrame:
    return pick(df, {c: (c,) for c in (COMPANY, "cik")} | {"sec_name": ("company_name",), "primary_ticker": ("primary_ticker",), "ticker_count": ("ticker_count",), "source_class": ("source_class",)})


def is_company(c: str = "institution_type") -> Column:
    return F.lower(F.coalesce(c, F.lit(""))) == "company"


def has_text(c: str) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def exact_bridge(companies: DataFrame, institutions: DataFrame) -> DataFrame:
    """Equal normalised names; accepted, at confidence 1, where the name is unique on both sides."""
    counted = lambda df, name, n: df.where(has_text(name)).withColumn("normalized_name", norm_name(F.col(name))).withColumn(n, F.count("*").over(W.partitionBy("normalized_name"))).where("normalized_name <> ''")
    both = counted(companies_of(companies), "sec_name", "sec_name_count").join(counted(institutions_of(institutions), "openalex_name", "openalex_name_count"), "normalized_name")
    one = (F.col("sec_name_count") == 1) & (F.col("openalex_name_count") == 1)
    return both.withColumns({"match_method": F.lit(EXACT), "accepted": one, "confidence": F.when(one, 1.0).otherwise(0.0)})


def one_to_one(bridge: DataFrame, what: str) -> None:
    """Raise where a key of an accepted bridge is missing or stands in two rows."""
    row = bridge.agg(F.count("*").alias("n"), F.countDistinct(COMPANY).alias("c"), F.countDistinct(INSTITUTION).alias("i"), F.count_if(~(has_text(COMPANY) & has_text(INSTITUTION))).alias("none")).first()
    if row["none"] or row["n"] != row["c"] or row["n"] != row["i"]:
        raise ValueError(f"{what}: {row['n']} rows, {row['c']} companies, {row['i']} institutions, {row['none']} without a key")


def scored_bridge(companies: DataFrame, institutions: DataFrame, exact: DataFrame) -> DataFrame:
    """Candidates beyond exact names: equal legal cores, then blocked fuzzy cores. exact: the accepted pairs.

    Similarity is of the cores without their spaces, company first. A best fuzzy candidate is accepted only if very close, clear of the second and
    borne out by an acronym or a company type."""
    def named(df: DataFrame, name: str, side: str) -> DataFrame:
        df = df.withColumn(f"{side}_core", legal_core(norm_name(F.col(name))))
        uses = F.when(F.col(f"{side}_core") != "", F.count("*").over(W.partitionBy(f"{side}_core"))).otherwise(0)
        return df.withColumns({f"{side}_acro": acronym(F.col(f"{side}_core")), f"{side}_flat": compact(F.col(f"{side}_core")), f"{side}_uses": uses})

    c = named(companies_of(companies).drop("ticker_count").withColumn("sec_name", F.coalesce("sec_name", F.lit(""))), "sec_name", "sec").join(exact.select(COMPANY), COMPANY, "left_anti")
    i = named(institutions_of(institutions), "openalex_name", "oa").join(exact.select(INSTITUTION), INSTITUTION, "left_anti")
    same = (F.col("sec_acro") != "") & (F.col("sec_acro") == F.col("oa_acro"))
    alone = {"unique_sec_core": F.col("sec_uses") == 1, "unique_openalex_core": F.col("oa_uses") == 1}
    unique = alone["unique_sec_core"] & alone["unique_openalex_core"]
    core = c.where("sec_core <> ''").join(i, F.col("sec_core") == F.col("oa_core")).withColumns({
        "method": F.lit(CORE), "name_similarity": F.lit(1.0), "acronym_match": same, "confidence": F.when(unique, CORE_UNIQUE).otherwise(CORE_AMBIGUOUS), "accepted": unique,
        "candidate_rank": F.lit(None).cast("int"), "best_margin": F.lit(None).cast("double"), **alone,
    })
    done = core.where("accepted").select(COMPANY, INSTITUTION)
    left = c.join(done.select(COMPANY), COMPANY, "left_anti").where(F.length("sec_flat") >= LEAST_COMPANY_CHARS)
    right = i.join(done.select(INSTITUTION), INSTITUTION, "left_anti").where(F.length("oa_flat") >= LEAST_INSTITUTION_CHARS)
    pairs = blocked_pairs(left, right, "sec_flat", "oa_flat", least=FUZZY_LEAST).withColumn("name_similarity", sequence_ratio(F.col("sec_flat"), F.col("oa_flat"))).where(F.col("name_similarity") >= FUZZY_LEAST)
    scored = pairs.withColumns({"acronym_match": same, **alone}).withColumn("score", F.col("name_similarity") + F.when(F.col("acronym_match"), ACRONYM_BONUS).otherwise(0.0) + F.when(is_company(), COMPANY_BONUS).otherwise(0.0))
    order = W.partitionBy(COMPANY).orderBy(F.desc("score"), F.asc(INSTITUTION))
    ranked = scored.withColumns({"candidate_rank": F.row_number().over(order), "margin": F.col("score") - F.lead("score", 1, 0.0).over(order)}).where(F.col("candidate_rank") <= TOP)
    best = F.col("candidate_rank") == 1
    auto = best & (F.col("name_similarity") >= FUZZY_AUTO) & (F.col("margin") >= MARGIN_AUTO) & (F.col("acronym_match") | is_company())
    fuzzy = ranked.withColumns({"method": F.lit(FUZZY), "accepted": auto, "confidence": F.least("score", F.when(best, MOST).otherwise(MOST_NOT_BEST)), "best_margin": F.when(best, F.col("margin"))})
    kept = [COMPANY, "cik", "sec_name", "primary_ticker", "source_class", INSTITUTION, "openalex_name", "ror", "country_code", "institution_type", "method", "name_similarity", F.col("name_similarity").alias("core_similarity"), "acronym_match",
            "unique_sec_core", "unique_openalex_core", "confidence", F.when(F.col("accepted"), "HIGH").otherwise("REVIEW").alias("tier"), "accepted", "candidate_rank", "best_margin"]
    return core.select(*kept).unionByName(fuzzy.select(*kept))


BRIDGE = (COMPANY, "cik", "sec_name", "primary_ticker", "source_class", INSTITUTION, "openalex_name", "ror", "country_code", "institution_type")


def accepted_union(exact: DataFrame, accepted: DataFrame) -> DataFrame:
    """The accepted bridge of fifteen columns: exact links, then scored ones that clash with none of them on either side."""
    first = exact.select(*BRIDGE, "match_method", "confidence", F.lit("EXACT").alias("confidence_tier"), F.lit(True).alias("accepted"), F.lit("exact_anchor").alias("provenance"))
    rest = anti_any(accepted.where("accepted"), exact, [COMPANY, INSTITUTION])
    return first.unionByName(rest.select(*BRIDGE, F.col("method").alias("match_method"), "confidence", F.col("tier").alias("confidence_tier"), "accepted", F.lit("scored_matcher").alias("provenance")))


def finalize_organizations(companies: DataFrame, exact: DataFrame, accepted: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted bridge, organization master, review queue: the best candidate of each company without an accepted link)."""
    bridge = accepted_union(exact, accepted)
    one_to_one(bridge, "accepted bridge")
    link = bridge.select(COMPANY, INSTITUTION, "openalex_name", "ror", F.col("country_code").alias("openalex_country_code"), F.col("institution_type").alias("openalex_institution_type"), "match_method", F.col("confidence").alias("match_confidence"), "confidence_tier", F.col("provenance").alias("match_provenance"))
    own = ("cik", "company_name", "primary_ticker", "ticker_count", "in_ticker_master", "in_filing_universe", "filing_count", "source_class")
    named = pick(companies, {COMPANY: (COMPANY,), **{c: (c,) for c in own}})
    master = named.join(link, COMPANY, "left").select(F.col(COMPANY).alias("canonical_org_id"), COMPANY, *own, *link.columns[1:], F.col(INSTITUTION).isNotNull().alias("has_openalex_link"))
    open_ = candidates.where(~F.col("accepted")).join(bridge.select(COMPANY), COMPANY, "left_anti")
    return bridge, master, top_n(open_, [COMPANY], [F.desc_nulls_last("confidence"), F.asc_nulls_last("candidate_rank"), F.asc_nulls_last(INSTITUTION)])


def quarantine_reason() -> Column:
    """The first reason that holds, in order; null reaches production. A null confidence or method passes its own arm."""
    reasons = (
        (F.col("confidence") < PRODUCTION_LEAST, "LOW_CONFIDENCE"),
        (~F.col("match_method").isin(EXACT, CORE), "METHOD_NOT_PRODUCTION_APPROVED"),
        (~is_company(), "OPENALEX_TYPE_NOT_COMPANY"),
        (~has_text("ror"), "ROR_MISSING"),
    )
    return F.coalesce(*(F.when(holds, F.lit(name)) for holds, name in reasons))


def promote(accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(production, quarantine with its reasons); production must be one to one."""
    judged = accepted.withColumn("quarantine_reason", quarantine_reason())
    production = judged.where("quarantine_reason is null").drop("quarantine_reason")
    row = production.agg(F.count("*").alias("n"), F.countDistinct(COMPANY).alias("c"), F.countDistinct(INSTITUTION).alias("i")).first()
    if row["n"] != row["c"] or row["n"] != row["i"]:
        raise ValueError(f"production bridge: {row['n']} rows, {row['c']} companies, {row['i']} institutions")
    return production, judged.where("quarantine_reason is not null")


def country_of(description: Column, code: Column, foreign: Column, names: dict[str, str] | None = None, us_states: tuple[str, ...] = US_STATE_CODES) -> Column:
    """Country of an address: US for a state's code of an address known not to be foreign; else the description as a country's name, or the
    longest name that it starts or ends with; null if none."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(description, F.lit(""))), r"\s*\([^)]*\)\s*", " "), "[^A-Z0-9]+", " "))
    by_length = sorted((COUNTRY_CODES if names is None else names).items(), key=lambda x: -len(x[0]))
    whole = [F.when(clean == n, F.lit(iso)) for n, iso in by_length]
    part = [F.when(F.startswith(clean, F.lit(n + " ")) | F.endswith(clean, F.lit(" " + n)), F.lit(iso)) for n, iso in by_length]
    home = foreign.isNotNull() & ~truthy(foreign) & F.upper(F.trim(F.coalesce(code, F.lit("")))).isin(*us_states)
    return F.when(home, "US").otherwise(F.coalesce(*whole, *part))


def issuer_countries(metadata: DataFrame) -> DataFrame:
    """(canonical_company_id, sec_business_country_iso2) of issuer metadata."""
    where = country_of(F.col("business_state_or_country_description"), F.col("business_state_or_country"), F.col("business_is_foreign_location"))
    return metadata.select(COMPANY, where.alias("sec_business_country_iso2"))


def geo_decision(links: DataFrame) -> DataFrame:
    """links (source_bucket accepted, quarantine or review, sec_business_country_iso2, country_code, institution_type, ror, confidence) with the comparison
    of countries, the decision, its reason and production_approved_v2. A contradiction rejects; else the bucket's own gates hold."""
    theirs = F.nullif(F.upper(F.trim(F.coalesce("country_code", F.lit("")))), F.lit(""))
    df = links.withColumn("openalex_country_iso2", theirs)
    comparable = has_text("sec_business_country_iso2") & F.col("openalex_country_iso2").isNotNull()
    agree = F.coalesce(F.col("sec_business_country_iso2") == F.col("openalex_country_iso2"), F.lit(False))
    df = df.withColumns({"country_comparable": comparable, "country_match": comparable & agree, "country_conflict": comparable & ~agree})
    firm, ror, sure = F.lower(F.trim(F.coalesce("institution_type", F.lit("")))) == "company", has_text("ror"), F.coalesce("confidence", F.lit(0.0))
    match, bucket = F.col("country_match"), F.col("source_bucket")
    rules = [
        (F.col("country_conflict"), "REJECT", "sec_openalex_country_conflict"),
        (bucket == "accepted", "KEEP_PRODUCTION", "production_link_no_country_conflict"),
        ((bucket == "quarantine") & firm & ror & (sure >= PRODUCTION_LEAST), "PROMOTE", "corporate_type_ror_high_confidence_no_country_conflict"),
        ((bucket == "quarantine") & match & ror & (sure >= PRODUCTION_LEAST), "REVIEW_PRIORITY", "country_match_ror_high_confidence_but_noncompany_type"),
        (bucket == "quarantine", "KEEP_QUARANTINE", "metadata_gate_not_cleared"),
        (match & firm & ror & (sure >= PROMOTE_LEAST), "PROMOTE", "country_match_company_type_ror_high_confidence"),
        (match & ror & (sure >= PRIORITY_LEAST), "REVIEW_PRIORITY", "country_match_ror_moderate_confidence"),
        (F.lit(True), "KEEP_REVIEW", "review_evidence_not_sufficient"),
    ]
    verdict = F.coalesce(*(F.when(holds, F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))) for holds, d, r in rules))
    (v,) = fresh(df.columns, "v")
    df = df.withColumn(v, verdict).withColumns({"reclassification_decision": F.col(v)["decision"], "reclassification_reason": F.col(v)["reason"]}).drop(v)
    return df.withColumn("production_approved_v2", F.col("reclassification_decision").isin("KEEP_PRODUCTION", "PROMOTE"))


def reclassify(metadata: DataFrame, production: DataFrame, quarantine: DataFrame, review: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all links with their decisions, the production bridge of the kept and promoted ones) of three buckets with unlike columns."""
    every = None
    for bucket, df in (("accepted", production), ("quarantine", quarantine), ("review", review)):
        first = lambda *names, df=df: F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns), F.lit(None).cast("string"))
        df = df.withColumns({"match_method": F.coalesce(first("match_method", "method"), F.lit("")), "confidence_tier": first("confidence_tier", "tier"), "source_bucket": F.lit(bucket)})
        every = df if every is None else every.unionByName(df, allowMissingColumns=True)
    judged = geo_decision(every.join(issuer_countries(metadata), COMPANY, "left"))
    return judged, judged.where("production_approved_v2")


def priority_review(judged: DataFrame) -> DataFrame:
    """Links for a person to see first, most certain first; a column that is missing is null."""
    rows = judged.where("reclassification_decision = 'REVIEW_PRIORITY'")
    if rows.isEmpty():
        raise ValueError("no link has priority for review")
    return pick(rows, {c: (c,) for c in PRIORITY_COLUMNS}).orderBy(F.desc_nulls_last("confidence"), COMPANY)


def adjudicate(base: DataFrame, reclassified: DataFrame, decisions: DataFrame, version: str, require: str | None = None, expected: int | None = None) -> DataFrame:
    """base plus the rows promoted by hand that it lacks, by name and distinct; still one to one."""
    chosen = reclassified.join(decisions.where("decision = 'PROMOTE'").select(COMPANY).distinct(), COMPANY)
    if require:
        chosen = chosen.where(F.col("reclassification_decision") == require)
    chosen = chosen.join(base.select(COMPANY), COMPANY, "left_anti").withColumn("adjudication_version", F.lit(version))
    if expected is not None and (n := chosen.count()) != expected:
        raise ValueError(f"{n} rows to promote, {expected} expected")
    out = base.unionByName(chosen, allowMissingColumns=True).distinct()
    row = out.agg(F.count("*").alias("n"), F.countDistinct(COMPANY).alias("c"), F.countDistinct(INSTITUTION).alias("i")).first()
    if not row["n"] == row["c"] == row["i"]:
        raise ValueError("the bridge is not one to one")
    return out


def last_decisions(decisions: DataFrame) -> DataFrame:
    """The last decision of each company over versions and places."""
    return decisions.groupBy(COMPANY).agg(F.max_by("decision", F.struct("version", "position")).alias("decision"))


def rank_unresolved(judged: DataFrame, decisions: DataFrame) -> DataFrame:
    """Links that neither the rules nor a person's last decision has settled, with score and tier, ranked over all."""
    from lakequery.functions.rank import global_rank

    settled = last_decisions(decisions).where(F.col("decision").isin("PROMOTE", "REJECT")).select(COMPANY)
    open_ = judged.where(~F.col("reclassification_decision").isin("KEEP_PRODUCTION", "PROMOTE", "REJECT")).join(settled, COMPANY, "left_anti")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    open_ = open_.withColumns({
        "type_company": flag(is_company()), "has_ror": flag(has_text("ror")), "has_country_match": flag(F.col("country_match")), "has_country_conflict": flag(F.col("country_conflict")),
        "method_score": F.coalesce(F.array_position(F.array(*(F.lit(m) for m in (FUZZY, CORE, EXACT))), F.col("match_method")), F.lit(0)).cast("int"),
    })
    weights = {"type_company": 12, "has_ror": 8, "has_country_match": 15, "has_country_conflict": -100, "method_score": 5}
    score = F.coalesce("confidence", F.lit(0.0)) * 100 + sum(F.col(c) * w for c, w in weights.items()) + flag(F.col("source_bucket") == "quarantine") * 3
    geo, ror, sure = F.col("has_country_match") == 1, F.col("has_ror") == 1, F.col("confidence")
    tiers = [(F.col("has_country_conflict") == 1, 5, BLOCKED), (geo & (F.col("type_company") == 1) & ror & (sure >= 0.93), 1, TIER_A), (geo & ror & (sure >= 0.90), 2, TIER_B), (ror & (sure >= 0.90), 3, TIER_C), (F.lit(True), 4, TIER_D)]
    tier = F.coalesce(*(F.when(holds, F.struct(F.lit(n).alias("place"), F.lit(name).alias("name"))) for holds, n, name in tiers))
    scored = open_.withColumns({"review_score": score, "_tier": tier}).withColumns({"review_tier": F.col("_tier.name"), "tier_place": F.col("_tier.place")}).drop("_tier")
    return global_rank(scored, [F.asc("tier_place"), F.desc("review_score"), F.asc(COMPANY)], "review_rank").drop("tier_place")
