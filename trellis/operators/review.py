"""Dictionary and fallback lookups, review merging, field accuracy and feature budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trellis.operators.link import canonical_label, keep_best


def formula_guard(text: Column) -> Column:
    """Text that a spreadsheet would run as a formula gets a leading apostrophe."""
    return F.when(text.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def trailing_alias(name: Column) -> Column:
    """The content of a trailing parenthesis group, else null."""
    found = F.trim(F.regexp_extract(name, r"\(([^()]+)\)\s*$", 1))
    return F.when(found != "", found)


def dictionary_lookup(rows: DataFrame, words: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with the value of their key: an exact key wins over one that differs in case only."""
    exact = words.select(F.col(key), F.col(value).alias("__exact"))
    folded = words.groupBy(F.lower(key).alias("__low")).agg(F.min_by(value, key).alias("__folded"))
    joined = rows.join(exact, key, "left").join(folded, F.lower(rows[key]) == F.col("__low"), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce("__exact", "__folded").alias(value))


def tiered_match(rows: DataFrame, known: DataFrame, tiers: list[list[str]], value: str, order: str) -> DataFrame:
    """``rows`` with the value of the first tier of keys that fits, and the tier's number (null: none fits)."""
    out, values = rows, []
    for n, keys in enumerate(tiers):
        first = known.groupBy(*keys).agg(F.min_by(value, order).alias(f"__{n}"))
        out = out.join(first, keys, "left")
        values.append(F.col(f"__{n}"))
    tier = F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in enumerate(values)])
    return out.select(*rows.columns, F.coalesce(*values).alias(value), tier.alias("tier"))


def review_merge(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """(key, action, decision): what a batch of reviews does to the stored ones.

    A pending review is replaced; a decided one only by a review that says it supersedes and has a note, and is
    in conflict with any other.  Both sides have columns decision, and the incoming one supersedes and note.
    """
    old, new = stored.select(key, F.col("decision").alias("old")), incoming.select(key, F.col("decision").alias("new"), "supersedes", "note")
    allowed = F.coalesce("supersedes", F.lit(False)) & (F.trim(F.coalesce("note", F.lit(""))) != "")
    action = (
        F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "insert").when(F.col("old") == F.col("new"), "unchanged")
        .when(F.col("old") == "pending", "replace").when(allowed, "supersede").otherwise("conflict")
    )
    joined = old.join(new, key, "full").withColumn("action", action)
    return joined.select(key, "action", F.when(F.col("action").isin("kept", "unchanged", "conflict"), F.col("old")).otherwise(F.col("new")).alias("decision"))


def field_accuracy(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """(field, labelled, right, accuracy) over columns FIELD and FIELD_label; unlabelled values don't count."""
    counts = [F.struct(F.lit(f).alias("field"), F.count(f"{f}_label").alias("labelled"), F.count_if(F.col(f) == F.col(f"{f}_label")).alias("right")) for f in fields]
    one = pairs.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    return one.withColumn("accuracy", F.when(F.col("labelled") > 0, F.col("right") / F.col("labelled")))


def feature_budget(features: DataFrame, group: str, field: str, score: str, name: str, least: int, total: int) -> DataFrame:
    """The best ``least`` features of each field, then the best of the others up to ``total`` a group."""
    best = (F.desc(score), F.asc(name))
    ranked = features.withColumn("__rank", F.row_number().over(Window.partitionBy(group, field).orderBy(*best)))
    ranked = ranked.withColumn("__place", F.row_number().over(Window.partitionBy(group).orderBy(F.when(F.col("__rank") <= least, 0).otherwise(1), *best)))
    return ranked.filter((F.col("__rank") <= least) | (F.col("__place") <= total)).select(*features.columns)


def match_need(n: Column) -> Column:
    """Terms that must match of n: three tenths, two at least."""
    return F.greatest(F.lit(2), F.ceil(F.lit(3) * n / F.lit(10))).cast("int")


def fallback_match(rows: DataFrame, known: DataFrame, disease: str, syndrome: str, value: str, line: str, noise: list[str] = ()) -> DataFrame:
    """``rows`` with the value of the first known row by line that has both keys, else the same disease and a word of the
    syndrome, else a syndrome with its first word anywhere in it; and the tier, 0 to 2.

    Words have three letters or more, without the ``noise`` words.
    """
    low = lambda df, *more: df.select(F.lower(F.trim(disease)).alias("__d"), F.lower(F.trim(syndrome)).alias("__s"), *more)
    asked, have = low(rows).distinct(), low(known, F.struct(line, value).alias("__v"))
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(list(noise)) if noise else F.length(w) >= 3)
    exact = have.groupBy("__d", "__s").agg(F.min("__v").alias("__0"))
    has = known.select(F.lower(F.trim(disease)).alias("__d"), F.lower(F.trim(syndrome)).alias("__t"), F.struct(line, value).alias("__v"))
    same = asked.select("__d", "__s", F.explode(F.array_distinct(words(F.col("__s")))).alias("__w")).join(has, "__d").filter(F.col("__t").contains(F.col("__w")))
    first = asked.select("__s", F.get(F.split("__s", " "), F.lit(0)).alias("__w")).filter(F.length("__w") >= 3).distinct()
    # A first word that is looked for inside longer words, too: few distinct syndromes on both sides.
    anywhere = first.join(has.select("__t", "__v").groupBy("__t").agg(F.min("__v").alias("__v")), F.col("__t").contains(F.col("__w")))
    out = rows.withColumn("__d", F.lower(F.trim(disease))).withColumn("__s", F.lower(F.trim(syndrome)))
    out = out.join(exact, ["__d", "__s"], "left").join(same.groupBy("__d", "__s").agg(F.min("__v").alias("__1")), ["__d", "__s"], "left").join(anywhere.groupBy("__s").agg(F.min("__v").alias("__2")), "__s", "left")
    tier = F.coalesce(*[F.when(F.col(f"__{n}").isNotNull(), F.lit(n)) for n in range(3)])
    return out.select(*rows.columns, F.coalesce("__0", "__1", "__2")[value].alias(value), tier.alias("tier"))


# Fields of a result that only some roles see, and of an item of its reference for the others.
INTERNAL = ["vision_details", "input_fusion", "has_makeup"]
SHOWN_ITEM = ["ten_benh", "icd10_code", "trang_thai_label"]
APPROVED = "da_kiem_duyet"


def role_view(result: Column, items: Column, role: Column, allowed: list[str], most: int = 5) -> Column:
    """struct of the allowed fields of a result and its reference items: whole for doctors; for others the first approved
    items with their shown fields only, and null where there is none.  Fields that nobody listed are never shown to others.
    """
    doctor = F.coalesce(role == "doctor", F.lit(False))
    shown = F.transform(F.slice(F.filter(items, lambda i: F.coalesce(i["trang_thai"] == APPROVED, F.lit(False))), 1, most), lambda i: F.struct(*[F.coalesce(i[c], F.lit("")).alias(c) for c in SHOWN_ITEM]))
    whole = F.transform(items, lambda i: F.struct(*[F.coalesce(i[c], F.lit("")).alias(c) for c in SHOWN_ITEM]))
    fields = [result[c].alias(c) if c in allowed else F.when(doctor, result[c]).alias(c) for c in [*allowed, *INTERNAL]]
    return F.struct(*fields, F.when(doctor, whole).when(F.size(shown) > 0, shown).alias("reference"))


def decision_reasons(names: Column, leads: Column, eligible: Column, flags: Column, duplicate: Column, ui: Column, tcm: Column, low_info: Column) -> Column:
    """struct(reasons, tier_a, priority) of a mapping by the codes that name and lead have exactly."""
    one_name, one_lead = F.size(names) == 1, F.size(leads) == 1
    conflict = (F.size(names) > 0) & (F.size(leads) > 0) & ~F.arrays_overlap(names, leads)
    same = one_name & one_lead & (names[0] == leads[0])
    clean = ~(duplicate | ui | tcm | low_info) & (F.size(flags) == 0)
    tier_a = F.coalesce(same & eligible & clean, F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(conflict, "exact_name_lead_conflict"),
        F.when(F.size(names) == 0, "name_not_exact").when(~one_name, "name_exact_not_unique"),
        F.when(F.size(leads) == 0, "lead_not_exact").when(~one_lead, "lead_exact_not_unique"),
        F.when(same & ~eligible, "exact_code_not_auto_single_code_eligible"), F.when(F.size(flags) > 0, "quality_flags_present"), F.when(duplicate, "duplicate_name_unresolved"),
        F.when(ui, "ui_or_template_row"), F.when(tcm, "tcm_or_classical_reference"), F.when(low_info, "low_information"), F.when(tier_a, "tier_a_exact_consensus_requires_human_review"),
    ))
    priority = (
        F.when(duplicate, "P0_duplicate_name").when(conflict, "P0_exact_conflict").when(ui | tcm, "P1_non_disease_or_tcm").when(low_info, "P1_low_information")
        .when(tier_a, "P2_validate_tier_a").otherwise("P1_manual_mapping")
    )
    return F.struct(reasons.alias("reasons"), tier_a.alias("tier_a"), priority.alias("priority"))


def invariants(proposals: DataFrame, rows: DataFrame, catalog: DataFrame, top: int = 5) -> DataFrame:
    """(invariant, violations) of proposals (id, fingerprint, code, tier_a, candidates) against rows (id, fingerprint) and
    catalog (code, eligible): every count is zero after a sound run.
    """
    exploded = proposals.select("id", F.posexplode("candidates").alias("at", "candidate"))
    known = catalog.select("code").distinct()
    bad = lambda df, name: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("invariant"), "violations")
    checks = [
        bad(proposals.groupBy("id").count().filter("count > 1"), "one_proposal_a_row"),
        bad(rows.join(proposals, "id", "left_anti"), "no_row_without_proposal"),
        bad(proposals.join(rows, "id", "left_anti"), "no_proposal_without_row"),
        bad(proposals.alias("p").join(rows.alias("r"), "id").filter("not (p.fingerprint <=> r.fingerprint)"), "fingerprints_fresh"),
        bad(proposals.filter(F.size("candidates") > top), "at_most_top_candidates"),
        bad(proposals.filter(F.size(F.array_distinct("candidates")) < F.size("candidates")), "candidates_distinct"),
        bad(exploded.join(known, F.col("candidate") == known["code"], "left_anti"), "candidates_in_catalog"),
        bad(proposals.filter(F.col("code").isNotNull() & ~F.col("tier_a")), "codes_of_tier_a_only"),
        bad(proposals.filter(F.col("code").isNull() & F.col("tier_a")), "tier_a_has_code"),
        bad(proposals.filter("code is not null").join(catalog.filter("eligible"), "code", "left_anti"), "codes_eligible"),
        bad(proposals.filter(F.col("code").isNotNull() & ~F.array_contains("candidates", F.col("code"))), "codes_among_candidates"),
        bad(catalog.groupBy("code").count().filter("count > 1"), "catalog_codes_unique"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def desired_mapping(rows: DataFrame, proposals: DataFrame, llm: DataFrame, reviews: DataFrame) -> DataFrame:
    """(id, code, status, source, new_code, new_status, orphan) for rows (id, code, status).

    An expert decides; then an exact proposal, then the consensus of votes, else nothing.  Rejected and unfinished
    reviews clear a code.  ``orphan``: a value would be erased that no proposal or review explains.
    """
    j = rows.join(proposals.select("id", F.col("code").alias("__auto")), "id", "left").join(llm.select("id", F.col("code").alias("__llm")), "id", "left").join(reviews.select("id", "decision", F.col("code").alias("__expert")), "id", "left")
    decided = F.col("decision").isNotNull() & (F.col("decision") != "pending")
    unmappable = F.col("decision").isin("unmappable", "not_a_disease")
    new_code = F.when(F.col("decision") == "approved", F.col("__expert")).when(decided, "").otherwise(F.coalesce("__auto", "__llm", F.lit("")))
    new_status = F.when(F.col("decision") == "approved", APPROVED).when(unmappable, "khong_anh_xa").otherwise("chua_kiem_duyet")
    source = F.when(F.col("decision") == "approved", "expert_approved").when(decided, F.col("decision")).when(F.col("__auto").isNotNull(), "machine_provisional").when(F.col("__llm").isNotNull(), "machine_llm_consensus").otherwise("none")
    changes = (F.coalesce("code", F.lit("")) != new_code) | (F.col("status") != new_status)
    held = (F.coalesce("code", F.lit("")) != "") | (F.col("status") != "chua_kiem_duyet")
    explained = decided | ((F.col("status") == "chua_kiem_duyet") & F.coalesce("__auto", "__llm").isNotNull())
    return j.select("id", "code", "status", source.alias("source"), new_code.alias("new_code"), new_status.alias("new_status"), F.coalesce(changes & held & ~explained, F.lit(False)).alias("orphan"))


def apply_mapping(plan: DataFrame, reconcile: bool = False) -> DataFrame:
    """(id, code, status) of a plan; orphans are refused unless they are to be reconciled."""
    if not reconcile and not plan.filter("orphan").isEmpty():
        raise ValueError("values would be erased that no proposal or review explains")
    return plan.select("id", F.col("new_code").alias("code"), F.col("new_status").alias("status"))


# Decisions of a review, and those that must say why.
DECISIONS = ["pending", "approved", "rejected", "needs_more_information", "unmappable", "not_a_disease"]
NOTED = ["rejected", "needs_more_information", "unmappable", "not_a_disease"]


def review_errors(reviews: DataFrame, rows: DataFrame, catalog: DataFrame, catalog_hash: str) -> DataFrame:
    """(id, errors) of reviews (id, row_hash, catalog_hash, decision, code, reviewer, reviewed_at, note): none for a sound one."""
    known = rows.select("id", F.col("row_hash").alias("__hash"))
    cat = catalog.select("code").distinct().withColumn("__code", F.lit(True))
    j = reviews.join(known, "id", "left").join(cat, "code", "left")
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    decided = F.col("decision").isin(DECISIONS) & (F.col("decision") != "pending")
    zoned = text("reviewed_at").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$") & text("reviewed_at").try_cast("timestamp").isNotNull()
    errors = F.array_compact(F.array(
        F.when(F.col("__hash").isNull(), "unknown_id").when(text("row_hash") == "", "row_hash_missing").when(F.col("row_hash") != F.col("__hash"), "row_hash_stale"),
        F.when(text("catalog_hash") != catalog_hash, "catalog_hash_stale"), F.when(~F.coalesce(F.col("decision").isin(DECISIONS), F.lit(False)), "decision_unknown"),
        F.when((text("code") != "") & F.col("__code").isNull(), "code_unknown"), F.when((F.col("decision") == "approved") & (text("code") == ""), "approved_without_code"),
        F.when((F.col("decision") != "approved") & (text("code") != ""), "code_without_approval"), F.when(decided & (text("reviewer") == ""), "reviewer_missing"),
        F.when(decided & (text("reviewed_at") == ""), "reviewed_at_missing").when(decided & ~zoned, "reviewed_at_without_zone"),
        F.when((F.col("decision") == "pending") & ((text("reviewer") != "") | (text("reviewed_at") != "") | (text("note") != "")), "pending_with_values"),
        F.when(F.col("decision").isin(NOTED) & (text("note") == ""), "note_missing"),
    ))
    return j.select("id", errors.alias("errors"))


def canonical_hierarchy(rows: DataFrame, levels: dict[str, str]) -> DataFrame:
    """``rows`` with one label for each code of each level (code column to label column), as ``canonical_label`` chooses it."""
    out = rows
    for code, label in levels.items():
        chosen = canonical_label(rows.filter(F.coalesce(F.col(label), F.lit("")) != ""), [code], label).withColumnRenamed("label", f"__{label}")
        out = out.join(chosen, code, "left").withColumn(label, F.coalesce(f"__{label}", label)).drop(f"__{label}")
    return out.select(*rows.columns)


def hierarchy_violations(rows: DataFrame, levels: dict[str, str]) -> DataFrame:
    """(level, code, labels) of codes that have several labels, or none: empty after ``canonical_hierarchy``."""
    out = None
    for code, label in levels.items():
        labels = rows.filter(F.col(code).isNotNull()).groupBy(F.col(code).cast("string").alias("code")).agg(F.count_distinct(F.nullif(F.col(label), F.lit(""))).alias("labels"))
        part = labels.filter("labels <> 1").select(F.lit(label).alias("level"), "code", "labels")
        out = part if out is None else out.unionByName(part)
    return out


def eligibility(more_specific: Column, mortality_only: Column, not_primary: Column, discouraged: Column, dagger: Column, asterisk: Column) -> Column:
    """struct(codable, morbidity, primary, single) of the restrictions of a code."""
    morbid = ~(more_specific | mortality_only)
    primary = F.when(~morbid, "not_usable").when(not_primary | asterisk, "forbidden").when(discouraged, "discouraged").otherwise("allowed")
    return F.struct((~more_specific).alias("codable"), morbid.alias("morbidity"), primary.alias("primary"), ((primary == "allowed") & ~dagger & ~asterisk).alias("single"))


def reference_index(rows: DataFrame, hidden: DataFrame, renamed: DataFrame, most: int = 12) -> DataFrame:
    """(id, title, code, symptoms, hidden, renamed) of the rows that name a disease; at most ``most`` symptoms each.

    ``rows`` has (id, name, code, symptoms, ui, tcm); adjudications of rows that have changed since are left out before.
    """
    kept = rows.filter(~(F.col("ui") | F.col("tcm")))
    j = kept.join(hidden.select("id").distinct().withColumn("__hidden", F.lit(True)), "id", "left").join(renamed.select("id", F.col("title").alias("__title")), "id", "left")
    symptoms = F.slice(F.transform(F.filter("symptoms", lambda s: F.length(s) >= 2), lambda s: F.lower(s)), 1, most)
    return j.select("id", F.coalesce("__title", "name").alias("title"), F.coalesce("code", F.lit("")).alias("code"), symptoms.alias("symptoms"), F.coalesce("__hidden", F.lit(False)).alias("hidden"), F.col("__title").isNotNull().alias("renamed"))


def gold_cases(rows: DataFrame, disease: str, cell: Column, line: str, least: int = 3, most: int = 6) -> DataFrame:
    """(disease, line, symptoms): the first fields of each disease's fullest row (ties: the first line); few fields, no case."""
    full = rows.select(disease, line, cell.alias("__f"))
    best = keep_best(full, [disease], [F.size("__f").desc(), F.col(line)]).filter(F.size("__f") >= least)
    return best.select(disease, line, F.slice("__f", 1, most).alias("symptoms"))


def stable_sample(rows: DataFrame, covered: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n distinct keys that nothing covers, the same ones on every run: those of the least hashes."""
    rest = rows.select(key).distinct().join(covered.select(key).distinct(), key, "left_anti")
    return rest.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
