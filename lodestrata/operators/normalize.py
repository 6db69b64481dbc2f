"""Normalization of parameter rows: names, families and scope, units, provenance, references, metadata, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.numeric import GOLD_UNITS, factor, to_float
from lodestrata.functions.text import blank_to_null, clean, family_mechanism, slug, strip
from lodestrata.operators.pick import last_by

#: Canonical names by symbol (fixed values).
SYMBOL_NAMES = {
    "tau0": "crss_initial", "τ0": "crss_initial", "g0": "crss_initial", "crss0": "crss_initial", "tau_sat": "crss_saturation", "taus": "crss_saturation", "h0": "hardening_h0",
    "h1": "hardening_h1", "q": "latent_ratio_q", "qab": "interaction_matrix_qab", "m": "rate_sensitivity_m", "n": "exponent_n", "gamma0": "gamma0_ref", "gammadot0": "gamma0_ref", "γ̇0": "gamma0_ref",
}
#: Canonical names by description (fixed values).
ALIAS_NAMES = {
    "critical resolved shear stress": "crss_initial", "critical shear strength": "crss_initial", "initial hardening modulus": "hardening_h0", "latent hardening coefficient": "latent_ratio_q",
    "rate sensitivity exponent": "exponent_n", "rate sensitivity": "exponent_n", "reference shear rate": "gamma0_ref",
}
#: Mechanism names (fixed values).
MECHANISMS = {
    "slip": "all_slip", "all slip": "all_slip", "all_slip": "all_slip", "twin": "all_twin", "twinning": "all_twin", "all_twin": "all_twin", "all_mechanisms": "all_mechanisms", "basal": "basal_slip",
    "basal slip": "basal_slip", "prismatic": "prismatic_slip", "prismatic slip": "prismatic_slip", "pyramidal": "pyramidal_slip", "pyramidal slip": "pyramidal_slip",
}
#: Origin types (fixed values).
ORIGINS = {
    "original": "original", "adopted": "adopted", "calibrated": "calibrated", "adopted_then_calibrated": "adopted_then_calibrated", "mixed_adopted_and_calibrated": "adopted_then_calibrated",
    "mixed": "adopted_then_calibrated",
}
#: Ids that mean the paper itself (fixed values).
THIS_STUDY = ["this_study", "this study", "present_study", "present study", "current_study", "current study", "our_work", "our work"]
#: Symbols that must have a value (fixed values); the review queue has one fewer.
KEY_SYMBOLS = ["tau0", "τ0", "n", "h0", "g0", "crss0"]
REVIEW_SYMBOLS = ["tau0", "τ0", "n", "h0", "g0"]
#: Source keys that are dropped (fixed values).
SOURCE_EXTRAS = ["adopted_references", "calibration_references", "references", "citations", "adopted_citations", "calibration_citations", "calibration_targets", "validation_targets"]


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def canonical_name(symbol: Column, name: Column, description: Column) -> Column:
    """By symbol, else name, else description; the given name where none is known."""
    key = F.translate(clean(symbol), ".-", "")
    return F.coalesce(lookup(SYMBOL_NAMES, key), lookup(ALIAS_NAMES, clean(name)), lookup(ALIAS_NAMES, clean(description)), name)


def mechanism(c: Column) -> Column:
    return F.coalesce(lookup(MECHANISMS, clean(c)), c)


def origin_type(origin: Column, kind: Column) -> Column:
    """The mapped origin, else its own lower-cased text; null where neither field is filled."""
    key = blank_to_null(clean(F.coalesce(blank_to_null(origin), kind)))
    return F.coalesce(lookup(ORIGINS, key), key)


def unique_ids(ids: Column) -> Column:
    """Trimmed, without empty ones and repeats, in first-seen order."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(ids, F.array().cast("array<string>")), lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != ""))


def is_this_study(x: Column) -> Column:
    return clean(x).isin(THIS_STUDY)


def roles(adopted: Column, calibration: Column, legacy: Column, flag: Column, strict: bool = False) -> Column:
    """Role lists of a source: adopted, calibration (without the paper itself and without adopted ids), what is left of the legacy list, the number of overlapping ids, and whether the paper calibrated.

    ``flag`` may be a text or a boolean's text; with ``strict`` any filled text counts as yes.
    """
    a, raw = unique_ids(adopted), unique_ids(calibration)
    own = F.filter(raw, lambda x: ~is_this_study(x))
    calib = F.array_except(own, a)
    rest = F.filter(unique_ids(legacy), lambda x: ~is_this_study(x))
    yes = (clean(flag) != "") if strict else clean(flag).isin("yes", "true", "1")
    return F.struct(
        a.alias("adopted"), calib.alias("calibration"), F.array_except(rest, F.array_union(a, calib)).alias("residual"), F.size(F.array_intersect(a, own)).alias("overlap"),
        (yes | F.exists(raw, is_this_study)).alias("this_study"),
    )


def all_ids(r: Column) -> Column:
    return F.array_distinct(F.concat(r["adopted"], r["calibration"], r["residual"]))


def normalize_units(value: Column, unit: Column, reported_value: Column, reported_unit: Column, table: dict | None = None) -> Column:
    """value, unit, value_si, unit_si and whether it was converted; reported fields fill what is missing."""
    v = F.coalesce(to_float(value), to_float(reported_value))
    u = F.coalesce(blank_to_null(clean(unit)), clean(reported_unit))
    f = factor(u, table) if table else factor(u)
    ok = v.isNotNull() & f.isNotNull()
    return F.struct(
        F.when(ok, v).otherwise(F.coalesce(to_float(value), v)).alias("value"), F.coalesce(unit, blank_to_null(u)).alias("unit"), F.when(ok, v * f).alias("value_si"), F.when(ok, "Pa").alias("unit_si"), ok.alias("converted")
    )


def unit_counts(rows: DataFrame, by: str = "block", converted: str = "converted") -> DataFrame:
    """Converted and skipped by block, with a total row."""
    c = F.col(converted)
    return rows.rollup(by).agg(F.count_if(c).alias("converted"), F.count_if(~c).alias("skipped")).withColumn(by, F.coalesce(F.col(by), F.lit("total")))


def families(docs: DataFrame, col: str, kind: str, key: str = "record_id") -> DataFrame:
    """(key, kind, ord, fkey, family_id, family_name, systems, num_systems, mechanism) of a record's families.

    Missing ids are made from name, plane or number; missing systems from their number; missing
    system ids are filled. Of families with one key, the last stands at the place of the first.
    """
    d = docs.select(key, F.posexplode(col).alias("ord", "f")).filter("f is not null")
    name, plane = F.col("f.family_name"), F.col("f.plane_direction")
    base = F.coalesce(blank_to_null(slug(name)), blank_to_null(slug(plane)), F.concat(F.lit(f"{kind}_"), (F.col("ord") + 1).cast("string")))
    given = blank_to_null(strip(F.coalesce(F.col("f.family_id"), F.lit(""))))
    d = d.withColumn("family_id", F.coalesce(given, F.concat(F.lit(f"{kind}_"), base))).withColumn("family_name", name).withColumn("plane_direction", plane)
    d = d.withColumn("fkey", slug(F.coalesce(blank_to_null(F.col("family_id")), blank_to_null(name), plane)))
    own = F.filter(F.coalesce(F.col("f.systems"), F.array().cast(docs.schema[col].dataType.elementType["systems"].dataType)), lambda s: s.isNotNull())
    n = F.col("f.num_systems").try_cast("int")
    made = F.when((F.size(own) == 0) & (n > 0), F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda j: F.concat(F.col("family_id"), F.lit("_s"), j.cast("string"))))
    filled = F.transform(own, lambda s, j: F.coalesce(blank_to_null(s["system_id"]), F.concat(F.col("family_id"), F.lit("_s"), (j + 1).cast("string"))))
    d = d.withColumn("systems", F.coalesce(made, filled)).withColumn("num_systems", F.when(F.size(own) > 0, F.size(own)).otherwise(n)).withColumn("mechanism", family_mechanism(name)).withColumn("kind", F.lit(kind))
    whole = Window.partitionBy(key, "kind", "fkey")
    d = d.withColumn("_last", F.row_number().over(whole.orderBy(F.desc("ord")))).withColumn("ord", F.min("ord").over(whole)).filter("_last = 1")
    return d.select(key, "kind", "ord", "fkey", "family_id", "family_name", "plane_direction", "systems", "num_systems", "mechanism")


#: Mechanisms of which a record's first slip family serves (fixed values).
FIRST_OF_MECHANISM = ["basal_slip", "prismatic_slip", "pyramidal_slip"]


def choose_family(params: DataFrame, fams: DataFrame, key: str = "record_id") -> DataFrame:
    """Adds ``family``: by id or name (slip before twin), else the first slip family of the mechanism, else the only family of the kind that the mechanism names; else null.

    One rule applies to a parameter, so it asks for one text; a family answers to its key, its mechanism and
    being the only one, and of those that answer to the same the first is kept by aggregation. A parameter then
    meets one family at most, however many its record has.
    """
    slip = F.col("kind") == "slip"
    asked = F.array_compact(
        F.array(
            F.concat(F.lit("name "), blank_to_null(F.col("fkey"))), F.when(slip & F.col("mechanism").isin(FIRST_OF_MECHANISM), F.concat(F.lit("first "), F.col("mechanism"))), F.when(slip, "only slip").otherwise("only twin"),
        )
    )
    item = F.struct("family_id", F.coalesce("family_name", "plane_direction").alias("family_name"), "systems", "num_systems")
    at = F.struct(F.when(slip, 0).otherwise(1).alias("k"), "ord", "fkey", F.col("mechanism").alias("mech"))
    answers = fams.select(key, "kind", F.explode(asked).alias("_rule"), at.alias("_at"), item.alias("family"))
    answers = answers.groupBy(key, "kind", "_rule").agg(F.count("*").alias("_n"), F.min_by("family", "_at").alias("family"), F.min("_at").alias("_at")).filter("_n = 1 OR _rule NOT LIKE 'only %'")
    answers = answers.groupBy(key, "_rule").agg(F.min_by("family", "_at").alias("family"))
    name, mech = slug(F.coalesce(blank_to_null(F.col("family_id")), F.col("family_name"))), slug(F.col("mechanism"))
    by_mech = F.when(F.col("_mech").isin(FIRST_OF_MECHANISM), F.concat(F.lit("first "), F.col("_mech"))).when(F.col("_mech").isin("twinning", "all_twin"), "only twin").when(F.col("_mech") == "all_slip", "only slip")
    d = params.withColumn("_name", name).withColumn("_mech", mech).withColumn("_rule", F.when(F.col("_name") != "", F.concat(F.lit("name "), F.col("_name"))).otherwise(by_mech))
    return d.join(answers, [key, "_rule"], "left").drop("_rule", "_name", "_mech")


def normalize_scope(params: DataFrame) -> DataFrame:
    """Scope rules over columns scope, phase_id, family_id, family_name, system_ids, system_count and ``family``.

    The matched family fills what is empty first; so a parameter whose family has systems gets scope
    system unless it names a scope. Fields that a scope has no use for are emptied.
    """
    empty_ids = F.col("system_ids").isNull() | (F.size("system_ids") == 0)
    d = params.withColumn("family_id", F.coalesce(blank_to_null(F.col("family_id")), F.col("family.family_id")))
    d = d.withColumn("family_name", F.coalesce(blank_to_null(F.col("family_name")), F.col("family.family_name")))
    d = d.withColumn("system_ids", F.when(empty_ids & (F.size("family.systems") > 0), F.col("family.systems")).otherwise(F.when(~empty_ids, F.col("system_ids"))))
    d = d.withColumn("system_count", F.coalesce("system_count", F.when(F.col("family").isNotNull(), F.coalesce(F.size(F.col("system_ids")), F.col("family.num_systems")))))
    s = slug(F.col("scope"))
    found = F.when(F.size("system_ids") > 0, "system").when(F.coalesce(blank_to_null(F.col("family_id")), blank_to_null(F.col("family_name"))).isNotNull(), "family").when(blank_to_null(F.col("phase_id")).isNotNull(), "phase").otherwise("global")
    d = d.withColumn("_given", s.isin("global", "phase", "family", "system")).withColumn("scope", F.when(s.isin("global", "phase", "family", "system"), s).otherwise(found))
    scope = F.col("scope")
    d = d.withColumn("phase_id", F.when(scope != "global", F.coalesce(blank_to_null(F.col("phase_id")), F.lit("phase_1"))))
    made = F.coalesce(F.col("family_id"), F.when(blank_to_null(F.col("family_name")).isNotNull(), F.concat(F.lit("family_"), slug(F.col("family_name")))), F.lit("family_1"))
    d = d.withColumn("family_id", F.when(scope == "family", made).when(scope == "system", F.col("family_id")))
    d = d.withColumn("family_name", F.when(scope.isin("family", "system"), F.col("family_name")))
    d = d.withColumn("system_ids", F.when(scope == "system", F.col("system_ids")))
    d = d.withColumn("system_count", F.when(scope == "system", F.coalesce("system_count", F.when(F.size("system_ids") > 0, F.size("system_ids")))).when(scope == "family", F.col("system_count")))
    return d.withColumn("scope_normalized", ~F.col("_given")).drop("_given")


def change_counts(before: DataFrame, after: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row: in how many rows each column differs between two states of a table."""
    b = before.select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    j = after.join(b, keys)
    return j.agg(F.count("*").alias("total"), *[F.count_if(~F.col(c).eqNullSafe(F.col(f"_{c}"))).alias(f"{c}_normalized") for c in cols])


def reference_map(refs: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """References by label, without empty labels; of one label the last counts."""
    keys = [*(by or []), "label"]
    return last_by(refs.filter(F.coalesce(F.col("label"), F.lit("")) != ""), keys, [order])


def resolve(ids: DataFrame, refs: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of (keys, role, label) with the labels known; adds ``resolved``."""
    known = refs.select(*[k for k in keys if k in refs.columns], "label").distinct().withColumn("_known", F.lit(True))
    return ids.join(known, [c for c in known.columns if c != "_known"], "left").withColumn("resolved", F.coalesce("_known", F.lit(False))).drop("_known")


def resolution_counts(resolved: DataFrame, by: str = "role") -> DataFrame:
    return resolved.groupBy(by).agg(F.count("*").alias("total"), F.count_if("resolved").alias("resolved"), F.sort_array(F.collect_set(F.when(~F.col("resolved"), F.col("label")))).alias("unresolved_labels"))


def backfill(rows: DataFrame, source: DataFrame, on: str, fills: dict[str, str]) -> DataFrame:
    """Left join that fills empty columns from another table's columns; ``backfilled`` where any was."""
    s = source.select(on, *[F.col(v).alias(f"_{k}") for k, v in fills.items()])
    d = rows.join(s, on, "left")
    empty = {k: F.coalesce(F.col(k).cast("string"), F.lit("")) == "" for k in fills}
    has = {k: F.coalesce(F.col(f"_{k}").cast("string"), F.lit("")) != "" for k in fills}
    flag = F.lit(False)
    for k in fills:
        flag = flag | (empty[k] & has[k])
    return d.select(*[F.when(empty[c] & has[c], F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fills else F.col(c) for c in rows.columns], flag.alias("backfilled"))


def has_evidence(text: Column, section: Column, kind: Column, ident: Column, page: Column, trimmed: bool = True) -> Column:
    some = lambda c: F.coalesce((strip(c) if trimmed else c) != "", F.lit(False))
    filled = lambda c: F.coalesce(c.cast("string") != "", F.lit(False))
    return some(text) | some(section) | filled(kind) | filled(ident) | filled(page)


def quality_issues(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per issue of rows with columns evidence (boolean), symbol, value, origin_type, n_adopted, n_calibration, this_study."""
    s, o = strip(F.coalesce("symbol", F.lit(""))), strip(F.coalesce("origin_type", F.lit("")))
    no_value = F.coalesce(F.col("value").cast("string"), F.lit("")) == ""
    found = F.array_compact(
        F.array(
            F.when(~F.col("evidence"), "missing_evidence"), F.when(F.lower(s).isin(KEY_SYMBOLS) & no_value, "missing_key_parameter_value"),
            F.when((o == "adopted") & ((F.col("n_calibration") > 0) | F.col("this_study")), "source_conflict_origin_vs_calibration"), F.when((o == "calibrated") & (F.col("n_adopted") > 0), "source_conflict_origin_vs_adopted"),
        )
    )
    return rows.select(*keys, F.explode(found).alias("type"))


ISSUES = ["missing_evidence", "missing_key_parameter_value", "source_conflict_origin_vs_calibration", "source_conflict_origin_vs_adopted"]


def quality_counts(issues: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: the number of rows, of issues, and of each type of issue, 0 where there is none."""
    counts = issues.agg(F.count("*").alias("issues"), *[F.count_if(F.col("type") == t).alias(t) for t in ISSUES])
    return rows.agg(F.count("*").alias("total")).crossJoin(F.broadcast(counts))


def metadata_from_xml(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """Adds title, doi, authors, journal and year as a publisher's XML has them; the DOI's pattern serves where the tag is absent."""
    from lodestrata.functions.numeric import year_of
    from lodestrata.functions.text import first_doi, xml_all, xml_first

    x = F.col(xml)
    return docs.withColumns(
        {
            "xml_title": xml_first(x, "dc:title"), "xml_doi": F.coalesce(xml_first(x, "prism:doi"), first_doi(x)), "xml_authors": xml_all(x, "dc:creator"), "xml_journal": xml_first(x, "prism:publicationName"),
            "xml_year": year_of(xml_first(x, "prism:coverDate")),
        }
    )


#: Where older records hold their parameters.
OLDER = (("elastic_parameters", "constants"), ("plastic_parameters", "parameters"))


def _put(obj: Column, **values: Column) -> Column:
    """An object (map of VARIANT) with these values, which replace those of the same keys; a null one leaves the key as it is."""
    new = F.map_filter(F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    return F.transform(F.array(new), lambda n: F.map_concat(F.map_filter(obj, lambda k, _: ~F.map_contains_key(n, k)), n))[0]


def older_document(doc: Column, gold: bool = True) -> Column:
    """A record of the older form (VARIANT) with numbers, SI values and SI units in both of its blocks; all else stays.

    ``gold`` labels take rates and blank units as factor 1, and their symbol, else canonical name, stripped. An item
    without a number or a known unit keeps its value. Blocks that are no objects or hold no list stay as they are.
    """

    def item(x: Column) -> Column:
        obj = F.try_variant_get(x, "$", "map<string,variant>")
        text = lambda k: F.try_variant_get(x, f"$.{k}", "string")
        known = factor(F.coalesce(text("unit"), F.lit("")), GOLD_UNITS) if gold else factor(F.coalesce(text("unit"), F.lit("")))
        read = F.struct(to_float(text("value")).alias("value"), text("unit").alias("unit"), known.alias("by"))
        return F.transform(F.array(read), lambda r: filled(x, obj, text, r["value"], r["unit"], r["by"]))[0]  # bound to a variable, so that they are read once

    def filled(x: Column, obj: Column, text, value: Column, unit: Column, by: Column) -> Column:
        ok = value.isNotNull() & by.isNotNull()
        si = F.when(F.lower(unit).isin("pa", "kpa", "mpa", "gpa"), F.lit("Pa")).otherwise(unit)
        new = {"value": F.when(ok, value).cast("variant"), "value_SI": F.when(ok, value * by).cast("variant"), "unit_SI": F.when(ok, F.coalesce(si.cast("variant"), F.parse_json(F.lit("null"))))}
        if gold:
            new["symbol"] = strip(F.coalesce(F.nullif(text("symbol"), F.lit("")), text("canonical_name"))).cast("variant")
        return F.when(obj.isNull(), x).otherwise(F.to_variant_object(_put(obj, **new)))

    def whole(d: Column) -> Column:
        root, new = F.try_variant_get(d, "$", "map<string,variant>"), {}
        for block, key in OLDER:
            items = F.try_variant_get(d, f"$.{block}.{key}", "array<variant>")
            of = F.try_variant_get(d, f"$.{block}", "map<string,variant>")
            new[block] = F.when(items.isNotNull(), F.to_variant_object(_put(of, **{key: F.to_variant_object(F.transform(items, item))})))
        return F.when(root.isNull(), d).otherwise(F.to_variant_object(_put(root, **new)))

    return F.transform(F.array(doc), whole)[0]  # bound to a variable, so that the text is parsed once
