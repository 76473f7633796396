"""Pre-filter, relevance score and the keep-or-drop decision with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import Profile, among, some, strings, with_scans
from . import articles as ar


def drop_reason(p: Profile, found: Column, url: Column) -> Column:
    """Why the pre-filter drops a row, from the terms found in its rule text; null: it stays. The first rule that applies names the reason."""
    blocked = F.lit(False)
    for domain in p.lists["blocked_domains"]:
        blocked = blocked | F.contains(url, F.lit(domain))
    on = lambda name: some(found, p.lists[name])
    return (F.when(F.coalesce(blocked, F.lit(False)), "blocked_domain").when(on("sports"), "sports")
            .when(on("politics") & ~on("finance"), "politics_only").when(on("lease") & ~on("strong"), "public_lease")
            .when(~on("strong") & on("show_strong"), "entertainment_strong").when(~on("strong") & (F.size(among(found, p.lists["show_weak"])) >= 2), "entertainment_weak"))


def with_score(df: DataFrame, p: Profile, text: str = "score_text", url: str = "link") -> DataFrame:
    """Adds matched_hard, matched_soft, matched_negative and score, and score_found, all terms of the profile in the text.

    The score is the weight of hard and soft terms less that of negative ones; generic enforcement terms count only
    beside a finance entity, negatives that are all capped noise cost at most 1 in a strong finance context,
    without hard terms the score stops at 2, and a blocked domain scores -50.
    """
    w, found = p.weights, F.col("score_found")
    if "score_found" not in df.columns:
        df = with_scans(df, p, p.every_term(), score_found=text)
    context = found
    if p.compact:  # hard terms and contexts are read in the spelling of the compact terms
        terms = [*p.every_term(), *(t for x in p.extras for t in (x["term"], *x["beside"], *x["without"]))]
        df = with_scans(df.withColumn("_context", p.canonical(F.col(text))), p, terms, context_found="_context").drop("_context")
        context = F.col("context_found")
    on = lambda name: some(context, p.lists[name])
    hard = among(context, list(w["hard"]))
    hard = F.when(on("entities"), hard).otherwise(F.array_except(hard, strings(p.lists["enforcement"])))
    out = df.withColumns({"matched_hard": hard, "matched_soft": among(found, list(w["soft"])), "matched_negative": among(found, list(w["negative"]))})

    def total(column: str, weights: dict[str, int]) -> Column:
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])
        return F.aggregate(column, F.lit(0), lambda acc, k: acc + F.coalesce(F.try_element_at(table, k), F.lit(0)))

    more = {"soft": F.lit(0), "negative": F.lit(0)}
    for x in p.extras:
        more[x["kind"]] = more[x["kind"]] + F.when(some(context, [x["term"]]) & some(context, x["beside"]) & ~some(context, x["without"]), x["points"]).otherwise(0)
    out = out.withColumns({"_hard": total("matched_hard", w["hard"]), "_soft": total("matched_soft", w["soft"]) + more["soft"], "_neg": total("matched_negative", w["negative"]) + more["negative"]})
    capped = F.size(F.array_except("matched_negative", strings(p.lists["capped"]))) == 0
    neg = F.when((F.col("_neg") > 1) & capped & on("context_strong") & on("risk"), F.lit(1)).otherwise(F.col("_neg"))
    score = F.col("_hard") + F.col("_soft") - neg
    score = F.when(F.col("_hard") <= 0, F.least(score, F.lit(2))).otherwise(score)
    blocked = F.lit(False)
    for domain in p.lists["blocked_domains"]:
        blocked = blocked | F.contains(F.lower(F.coalesce(url, F.lit(""))), F.lit(domain))
    return out.withColumn("score", F.when(blocked, -50).when(F.coalesce(F.col(text), F.lit("")) == "", 0).otherwise(score).cast("int")).drop("_hard", "_soft", "_neg", "context_found")


def label(score: Column) -> Column:
    return F.when(score >= 8, "high").when(score >= 4, "med").otherwise("low")


def rule_decision(score: Column, hard: Column, negative: Column, min_score: int = 5) -> Column:
    """struct(keep, reason) from the score alone."""
    reason = (F.when(score >= min_score, "rule_keep_score_ge_threshold").when(F.size(negative) > 0, "rule_drop_negative_signal")
              .when(F.size(hard) == 0, "rule_drop_no_financial_anchor").otherwise("rule_drop_score_lt_threshold"))
    return F.struct((score >= min_score).alias("keep"), reason.alias("reason"))


def signals(df: DataFrame, p: Profile, found: str = "score_found") -> DataFrame:
    """The boolean context columns of the hybrid decision, from the terms found."""
    on = lambda name: some(F.col(found), p.lists[name])
    both = lambda a, b: on(a) & on(b)
    out = df.withColumns({
        "s_domain": some(F.col("matched_hard"), p.lists["domain"]) | on("domain") | both("enforcement", "entities"),
        "s_impact": both("impact_trigger", "impact_home"),
        "s_macro": on("global_macro"),
        "s_generic_hit": on("generic") | some(F.col("matched_hard"), p.lists["generic"]),
        "s_enforced": on("enforcement_always") | both("enforcement", "entities"),
        "s_strong": both("context_strong", "risk"),
        "s_capped": (F.size("matched_negative") > 0) & (F.size(F.array_except("matched_negative", strings(p.lists["capped"]))) == 0),
    })
    out = out.withColumns({"s_global": F.col("s_macro") & on("global_market"),
                           "s_low": ~F.col("s_impact") & ~F.col("s_macro") & (on("low_value") | both("mood_market", "mood"))})
    none = ~F.col("s_domain") & ~F.col("s_impact") & ~F.col("s_global")
    out = out.withColumns({"s_generic": none & F.col("s_generic_hit"), "s_corporate": none & both("corporate_macro", "corporate")})
    open_market = ~F.col("s_domain") & ~F.col("s_enforced") & ~F.col("s_impact") & ~(F.col("s_global") & ~F.col("s_low"))
    return out.withColumn("s_market", open_market & F.col("s_generic") & on("market_ipo"))


def hybrid_reason(prob: Column, keep: float = 0.65, drop: float = 0.35, strong: int = 8, gray: int = 6, no_model: int = 5, model: int = 5) -> Column:
    """The reason under the hybrid policy, over score, matched terms and signals; the order of rules is the policy."""
    score, domain, generic = F.col("score"), F.col("s_domain"), F.col("s_generic")
    negative, hard = F.size("matched_negative") > 0, F.size("matched_hard") > 0
    tag = lambda x: F.lit(f"candidate_hybrid_{x}")
    sure = domain | ((score >= model) & ~generic) | F.col("s_enforced")
    return (
        F.when(negative & (score >= no_model) & F.col("s_capped") & F.col("s_strong"), tag("keep_strong_finance_anchor_neg_cap"))
        .when(negative, tag("drop_negative_signal"))
        .when(F.col("s_low"), tag("drop_low_value_overseas_market_noise"))
        .when(F.col("s_impact"), tag("keep_overseas_korean_market_impact"))
        .when(F.col("s_global") & ~domain, tag("keep_overseas_global_reference"))
        .when(F.col("s_corporate"), tag("drop_corporate_macro_noise"))
        .when(F.col("s_market"), tag("drop_generic_market_or_ipo_noise"))
        .when((score >= strong) & hard & domain, tag("keep_strong_domain_rule_anchor"))
        .when((prob >= keep) & sure, tag("model_keep_prob_ge_threshold_with_domain_anchor"))
        .when(prob >= keep, tag("drop_model_keep_without_domain_anchor"))
        .when(prob <= drop, tag("model_drop_prob_le_threshold"))
        .when(prob.isNotNull() & (score < gray), tag("gray_drop_score_lt_threshold"))
        .when(prob.isNotNull() & ~domain & generic, tag("gray_drop_generic_anchor_only"))
        .when(prob.isNotNull() & ~domain, tag("gray_drop_no_domain_anchor"))
        .when(prob.isNotNull(), tag("gray_keep_domain_score_ge_threshold"))
        .when(score < no_model, tag("no_model_drop_score_lt_threshold"))
        .when(~domain, tag("no_model_drop_no_domain_anchor"))
        .otherwise(tag("no_model_keep_domain_score_ge_threshold")))


def decide(df: DataFrame, p: Profile, policy: str = "candidate_hybrid", prob: str = "prob", min_score: int = 5, min_prob: float = 0.55) -> DataFrame:
    """Adds relevance metadata under a policy: rule_only, candidate_hybrid or authoritative (model, else rule)."""
    rule = rule_decision(F.col("score"), F.col("matched_hard"), F.col("matched_negative"), min_score)
    pr = F.col(prob)
    if policy == "candidate_hybrid":
        out = signals(df, p).withColumn("decision_reason", hybrid_reason(pr))
        out = out.withColumn("keep", F.col("decision_reason").rlike("_keep_") & ~F.col("decision_reason").contains("drop_model_keep")).drop(*[c for c in out.columns if c.startswith("s_")])
    elif policy == "rule_only":
        out = df.withColumn("_d", rule).withColumns({"decision_reason": F.col("_d.reason"), "keep": F.col("_d.keep")}).drop("_d")
    elif policy == "authoritative":
        reason = F.when(pr >= min_prob, "model_keep_prob_ge_threshold").when(pr.isNotNull(), "model_drop_prob_lt_threshold").otherwise(rule["reason"])
        out = df.withColumns({"decision_reason": reason, "keep": F.when(pr.isNotNull(), pr >= min_prob).otherwise(rule["keep"])})
    else:
        raise ValueError(f"no such policy: {policy}")
    return out.withColumns({"decision": F.when(F.col("keep"), "keep").otherwise("drop"), "relevance_label": label(F.col("score")), "relevance_model_policy": F.lit(policy), "model_used": pr.isNotNull()})


def reason_counts(decided: DataFrame) -> DataFrame:
    return decided.groupBy("decision_reason", "keep").agg(F.count("*").alias("n"))


def loose_hits(p: Profile, text: Column) -> Column:
    """Whether a domain anchor occurs as a plain substring, whatever its boundaries; for monitoring only."""
    out = F.lit(False)
    for t in p.lists["domain"]:
        out = out | F.contains(text, F.lit(t.lower()))
    return out


def scored(docs: DataFrame, p: Profile) -> DataFrame:
    """Articles over documents with rule_text, score_text, the terms found in both, and scores."""
    base = ar.from_documents(docs)
    base = base.withColumns({"rule_text": ar.rule_text(F.col("title"), F.col("description"), F.col("query")), "score_text": ar.score_text(F.col("title"), F.col("description"))})
    return with_score(with_scans(base, p, p.every_term(), rule_found="rule_text", score_found="score_text"), p)
