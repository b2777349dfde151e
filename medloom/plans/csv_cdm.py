"""CDM tables from clinical CSV sources. ``src`` maps source table names to typed DataFrames.

Person, provider, care site and visit keys are hashes of source ids, so most joins of the row data shrink to
one: events to their encounter context. Surrogate row numbers over whole tables are replaced by hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import session as S
from medloom.functions.keys import string_id
from medloom.operators import temporal as TM
from medloom.operators import terminology as V
from medloom.operators.joins import keyed_join, lookup_join, may_match, within_period
from medloom.schema.cdm import conform
from medloom.session import checkpointed
from medloom.sources.clinical_csv import states

# Fixed values of the target tables.
GENDER = {"M": 8507, "F": 8532}
RACE = {"WHITE": 8527, "BLACK": 8516, "ASIAN": 8515}
ETHNICITY = {"HISPANIC": 38003563, "NONHISPANIC": 38003564}
VISIT_CLASS = {
    "ambulatory": 9202,
    "emergency": 9203,
    "inpatient": 9201,
    "wellness": 9202,
    "urgentcare": 9203,
    "outpatient": 9202,
}
FAMILY_PRACTICE = 38004446
TYPE_EHR = 32817
TYPE_ENCOUNTER = 32827
TYPE_PRESCRIPTION = 32838
TYPE_PERIOD = 32882
TYPE_OBSERVATION_FROM_EHR = 38000280
TYPE_CLAIM_COST = 32814
CURRENCY_USD = 44818668
DEATH_CERTIFICATION = "308646001"
VISIT_DETAIL_OFFSET = 1_000_000
CDM_VERSION_CONCEPT = 756265


@dataclass
class Sources:
    """Source tables, vocabulary, an optional custom code map, and the version of the export."""

    tables: dict[str, DataFrame]
    vocabulary: V.Vocabulary
    custom_map: DataFrame | None = None
    version: str = "3.3.0"
    # Write frames that several tables read once to the shared checkpoint folder.
    materialize: bool = False
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def once(self, name: str, build) -> DataFrame:
        if name not in self._frames:
            df = build()
            self._frames[name] = checkpointed(df) if self.materialize else df
        return self._frames[name]

    @property
    def to_standard(self) -> DataFrame:
        return self.once("to_standard", lambda: V.source_to_standard(self.vocabulary, self.custom_map))

    @property
    def to_source(self) -> DataFrame:
        return self.once("to_source", lambda: V.source_to_source(self.vocabulary, self.custom_map))

    @property
    def visits(self) -> DataFrame:
        return self.once("visits", lambda: TM.all_visits(self["encounters"]))

    @property
    def final(self) -> DataFrame:
        return self.once("final", lambda: TM.final_visits(self["encounters"], self.visits))


def _words(value: Column, table: dict[str, int], default: int | None = 0) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def _row_id(*parts: str | Column) -> Column:
    """A row key over the facts that make the row; absent facts keep their place."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return string_id(F.concat_ws("|", *texts))


# --- people and places ----------------------------------------------------------------------------


def location(src: Sources) -> DataFrame:
    sides = F.broadcast(states(src["patients"].sparkSession))
    places = src["patients"].select("city", "state", "zip").distinct().join(sides, "state", "left")
    rows = places.select("city", F.col("state_abbreviation").alias("state"), "zip").distinct()
    rows = rows.withColumn("location_id", string_id("zip")).withColumn("location_source_value", F.col("zip"))
    return conform(rows, "location")


def care_site(src: Sources) -> DataFrame:
    rows = src["organizations"].select(
        string_id("id").alias("care_site_id"),
        F.col("name").alias("care_site_name"),
        F.lit(0).alias("place_of_service_concept_id"),
        F.col("id").alias("care_site_source_value"),
    )
    return conform(rows, "care_site")


def provider(src: Sources) -> DataFrame:
    sex = _words(F.upper("gender"), GENDER, None)
    rows = src["providers"].select(
        string_id("id").alias("provider_id"),
        F.col("name").alias("provider_name"),
        F.lit(FAMILY_PRACTICE).alias("specialty_concept_id"),
        sex.alias("gender_concept_id"),
        F.col("id").alias("provider_source_value"),
        F.col("speciality").alias("specialty_source_value"),
        F.lit(FAMILY_PRACTICE).alias("specialty_source_concept_id"),
        F.col("gender").alias("gender_source_value"),
        sex.alias("gender_source_concept_id"),
    )
    return conform(rows, "provider")


def person(src: Sources) -> DataFrame:
    """Patients with a stated gender. A location matches by city, full state name and zip."""
    sides = F.broadcast(states(src["patients"].sparkSession))
    places = (
        location(src)
        .select("location_id", "city", F.col("state").alias("state_abbreviation"), "zip")
        .join(sides, "state_abbreviation", "left")
        .select("location_id", "city", "state", "zip")
        .distinct()
    )
    people = src["patients"].where("gender IS NOT NULL")
    rows = lookup_join(people, places, ["city", "state", "zip"], "left", small=None)
    born = F.col("birthdate")
    rows = rows.select(
        string_id("id").alias("person_id"),
        _words(F.upper("gender"), GENDER, None).alias("gender_concept_id"),
        F.year(born).alias("year_of_birth"),
        F.month(born).alias("month_of_birth"),
        F.dayofmonth(born).alias("day_of_birth"),
        born.alias("birth_datetime"),
        _words(F.upper("race"), RACE).alias("race_concept_id"),
        _words(F.upper("ethnicity"), ETHNICITY).alias("ethnicity_concept_id"),
        "location_id",
        F.col("id").alias("person_source_value"),
        F.col("gender").alias("gender_source_value"),
        F.lit(0).alias("gender_source_concept_id"),
        F.col("race").alias("race_source_value"),
        F.lit(0).alias("race_source_concept_id"),
        F.col("ethnicity").alias("ethnicity_source_value"),
        F.lit(0).alias("ethnicity_source_concept_id"),
    )
    return conform(rows, "person")


def _known_patients(src: Sources, df: DataFrame, column: str = "patient") -> DataFrame:
    """Rows whose patient is a person, with ``person_id``."""
    people = src["patients"].where("gender IS NOT NULL").select(F.col("id").alias(column)).distinct()
    return keyed_join(df, people, [column], "left_semi").withColumn("person_id", string_id(column))


def death(src: Sources) -> DataFrame:
    causes = src.to_standard.where(
        "target_domain_id = 'Condition' AND source_domain_id = 'Condition' AND target_vocabulary_id = 'SNOMED' "
        "AND source_vocabulary_id = 'SNOMED' AND target_standard_concept = 'S' AND target_invalid_reason IS NULL"
    ).select(F.col("source_code").alias("reasoncode"), "target_concept_id", "source_concept_id")
    last = src["encounters"].where(F.col("code") == DEATH_CERTIFICATION).select("patient", "start", "reasoncode")
    rows = lookup_join(_known_patients(src, last), causes, ["reasoncode"], "inner", src.vocabulary.small)
    rows = rows.select(
        "person_id",
        F.col("start").alias("death_date"),
        F.col("start").alias("death_datetime"),
        F.lit(TYPE_EHR).alias("death_type_concept_id"),
        F.col("target_concept_id").alias("cause_concept_id"),
        F.col("reasoncode").alias("cause_source_value"),
        F.col("source_concept_id").alias("cause_source_concept_id"),
    )
    return conform(rows, "death")


def observation_period(src: Sources) -> DataFrame:
    spans = TM.observation_spans(src["encounters"], "patient", "start", "stop")
    rows = _known_patients(src, spans).select(
        F.col("person_id").alias("observation_period_id"),
        "person_id",
        F.col("start_date").alias("observation_period_start_date"),
        F.col("end_date").alias("observation_period_end_date"),
        F.lit(TYPE_PERIOD).alias("period_type_concept_id"),
    )
    return conform(rows, "observation_period")


def payer_plan_period(src: Sources) -> DataFrame:
    """Payer transitions as periods; the oldest exports give years, later ones dates."""
    pt = src["payer_transitions"]
    if src.version == "2.7.0":
        first, last = [F.col(c).try_cast("int") for c in ("start_year", "end_year")]
        begin, finish = F.make_date(first, F.lit(1), F.lit(1)), F.make_date(last, F.lit(12), F.lit(31))
    elif src.version == "3.0.0":  # the year columns hold dates here
        begin, finish = [F.col(c).cast("string").try_cast("date") for c in ("start_year", "end_year")]
    else:
        begin, finish = F.col("start_date").cast("date"), F.col("end_date").cast("date")
    pt = pt.select("patient", "payer", begin.alias("_begin"), finish.alias("_finish"))
    payers = src["payers"].select(F.col("id").alias("payer"), F.col("name").alias("plan_source_value"))
    rows = lookup_join(_known_patients(src, pt), payers, ["payer"], "inner")
    rows = rows.select(
        _row_id("patient", "payer", "_begin", "_finish").alias("payer_plan_period_id"),
        "person_id",
        F.col("_begin").alias("payer_plan_period_start_date"),
        F.col("_finish").alias("payer_plan_period_end_date"),
        F.col("payer").alias("payer_source_value"),
        "plan_source_value",
        *[F.lit(0).alias(f"{p}_concept_id") for p in ("payer", "plan", "sponsor", "stop_reason")],
        *[F.lit(0).alias(f"{p}_source_concept_id") for p in ("payer", "plan", "sponsor", "stop_reason")],
    )
    return conform(rows, "payer_plan_period")


# --- visits ---------------------------------------------------------------------------------------


def _visit_rows(src: Sources, need_care_site: bool) -> DataFrame:
    used = src.final.select(F.col("visit_occurrence_id_new").alias("visit_occurrence_id")).distinct()
    visits = _known_patients(src, src.visits.join(used, "visit_occurrence_id", "left_semi"))
    facts = src["encounters"].select(
        F.col("id").alias("encounter_id"), "patient", "provider", F.col("organization").alias("care_site")
    )
    rows = keyed_join(visits, facts, ["encounter_id", "patient"])
    providers = src["providers"].select(F.col("id").alias("provider")).distinct()
    rows = lookup_join(rows, providers, ["provider"], "left_semi")
    if need_care_site:
        sites = src["organizations"].select(F.col("id").alias("care_site")).distinct()
        rows = lookup_join(rows, sites, ["care_site"], "left_semi")
    # Visits are rolled up to a few per person and day, which bounds the window.
    return TM.with_previous(
        rows, "person_id", ["visit_start_date", "visit_occurrence_id"], "visit_occurrence_id", "_previous"
    )


def visit_occurrence(src: Sources, need_care_site: bool = True) -> DataFrame:
    rows = _visit_rows(src, need_care_site)
    rows = rows.select(
        "visit_occurrence_id",
        "person_id",
        _words(F.lower("encounterclass"), VISIT_CLASS).alias("visit_concept_id"),
        "visit_start_date",
        F.col("visit_start_date").alias("visit_start_datetime"),
        "visit_end_date",
        F.col("visit_end_date").alias("visit_end_datetime"),
        F.lit(TYPE_ENCOUNTER).alias("visit_type_concept_id"),
        string_id("provider").alias("provider_id"),
        string_id("care_site").alias("care_site_id"),
        F.col("encounter_id").alias("visit_source_value"),
        F.lit(0).alias("visit_source_concept_id"),
        F.lit(0).alias("admitted_from_concept_id"),
        F.lit(0).alias("discharged_to_concept_id"),
        F.col("_previous").alias("preceding_visit_occurrence_id"),
    )
    return conform(rows, "visit_occurrence")


def visit_detail(src: Sources) -> DataFrame:
    rows = _visit_rows(src, need_care_site=False)
    rows = rows.select(
        (F.col("visit_occurrence_id") + VISIT_DETAIL_OFFSET).alias("visit_detail_id"),
        "person_id",
        _words(F.lower("encounterclass"), VISIT_CLASS).alias("visit_detail_concept_id"),
        F.col("visit_start_date").alias("visit_detail_start_date"),
        F.col("visit_start_date").alias("visit_detail_start_datetime"),
        F.col("visit_end_date").alias("visit_detail_end_date"),
        F.col("visit_end_date").alias("visit_detail_end_datetime"),
        F.lit(TYPE_ENCOUNTER).alias("visit_detail_type_concept_id"),
        string_id("provider").alias("provider_id"),
        F.col("encounter_id").alias("visit_detail_source_value"),
        F.lit(0).alias("visit_detail_source_concept_id"),
        F.lit(0).alias("admitted_from_concept_id"),
        F.lit(0).alias("discharged_to_concept_id"),
        (F.col("_previous") + VISIT_DETAIL_OFFSET).alias("preceding_visit_detail_id"),
        "visit_occurrence_id",
    )
    return conform(rows, "visit_detail")


# --- coded events ---------------------------------------------------------------------------------


def _standard(src: Sources, domain: str | None, **equal: str | tuple[str, ...]) -> DataFrame:
    """Standard targets of source codes under the given conditions, as (code, std_concept_id)."""
    rows = src.to_standard.where("target_standard_concept = 'S' AND target_invalid_reason IS NULL")
    if domain is not None:
        rows = rows.where(F.col("target_domain_id") == domain)
    for name, value in equal.items():
        values = (value,) if isinstance(value, str) else value
        rows = rows.where(F.col(name).isin(*values))
    return rows.select(F.col("source_code").alias("code"), F.col("target_concept_id").alias("std_concept_id"))


def _source(src: Sources, vocabularies: tuple[str, ...], domain: str | None = None) -> DataFrame:
    rows = src.to_source.where(F.col("source_vocabulary_id").isin(*vocabularies))
    if domain is not None:
        rows = rows.where(F.col("source_domain_id") == domain)
    return rows.select(F.col("source_code").alias("code"), F.col("source_concept_id").alias("src_concept_id"))


def _coded(src: Sources, df: DataFrame, standard: DataFrame, source: DataFrame, source_how: str = "inner") -> DataFrame:
    small = src.vocabulary.small
    rows = lookup_join(df, standard, ["code"], "inner", small)
    return lookup_join(rows, source, ["code"], source_how, small)


def _encounter_context(src: Sources) -> DataFrame:
    """One row per encounter: its patient, known provider and final visit."""
    providers = src["providers"].select(F.col("id").alias("provider"), string_id("id").alias("_provider_id")).distinct()
    facts = src["encounters"].select(F.col("id").alias("encounter"), F.col("patient").alias("_patient"), "provider")
    facts = lookup_join(facts, providers, ["provider"], "left").drop("provider")
    visits = src.final.select(F.col("encounter_id").alias("encounter"), F.col("visit_occurrence_id_new").alias("_visit"))
    return facts.join(visits, "encounter", "left")


def _in_context(src: Sources, df: DataFrame) -> DataFrame:
    """Adds person, visit and provider. The provider counts only when the encounter is the patient's own."""
    context = src.once("context", lambda: _encounter_context(src))
    rows = keyed_join(_known_patients(src, df), context, ["encounter"], "left")
    return rows.select(
        *df.columns,
        "person_id",
        F.when(F.col("_patient") == F.col("patient"), F.col("_provider_id")).alias("provider_id"),
        F.col("_visit").alias("visit_occurrence_id"),
        (F.col("_visit") + VISIT_DETAIL_OFFSET).alias("visit_detail_id"),
    )


def _is_33(src: Sources) -> bool:
    return tuple(int(part) for part in src.version.split(".")) >= (3, 3, 0)


def _procedure_day(src: Sources) -> Column:
    return F.col("date" if src.version == "2.7.0" else "start")


def condition_occurrence(src: Sources) -> DataFrame:
    vocabularies = ("SNOMED", "ICD10CM") if _is_33(src) else ("SNOMED",)
    standard = _standard(src, "Condition", target_vocabulary_id="SNOMED", source_vocabulary_id=vocabularies)
    rows = src["conditions"].select("start", "stop", "patient", "encounter", "code")
    rows = _in_context(src, _coded(src, rows, standard, _source(src, vocabularies)))
    rows = rows.select(
        _row_id("patient", "encounter", "code", "start", "stop", "std_concept_id", "src_concept_id").alias(
            "condition_occurrence_id"
        ),
        "person_id",
        F.col("std_concept_id").alias("condition_concept_id"),
        F.col("start").alias("condition_start_date"),
        F.col("start").alias("condition_start_datetime"),
        F.col("stop").alias("condition_end_date"),
        F.col("stop").alias("condition_end_datetime"),
        F.lit(TYPE_ENCOUNTER).alias("condition_type_concept_id"),
        F.lit(0).alias("condition_status_concept_id"),
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        F.col("code").alias("condition_source_value"),
        F.col("src_concept_id").alias("condition_source_concept_id"),
    )
    return conform(rows, "condition_occurrence")


def drug_exposure(src: Sources) -> DataFrame:
    meds = src["medications"].select(
        "patient",
        "encounter",
        "code",
        "start",
        F.coalesce("stop", "start").alias("_end"),
        F.col("stop").alias("_verbatim"),
        F.coalesce(F.datediff("stop", "start"), F.lit(0)).alias("_days"),
        F.lit(TYPE_PRESCRIPTION).alias("_type"),
    )
    meds = _coded(src, meds, _standard(src, "Drug", target_vocabulary_id="RxNorm"), _source(src, ("RxNorm",)))
    shots = src["immunizations"].select(
        "patient",
        "encounter",
        "code",
        F.col("date").alias("start"),
        F.col("date").alias("_end"),
        F.col("date").alias("_verbatim"),
        F.lit(0).alias("_days"),
        F.lit(TYPE_ENCOUNTER).alias("_type"),
    )
    shots = _coded(src, shots, _standard(src, "Drug", target_vocabulary_id="CVX"), _source(src, ("CVX",)))
    rows = _in_context(src, meds.unionByName(shots)).select(
        _row_id("_type", "patient", "encounter", "code", "start", "_verbatim", "std_concept_id", "src_concept_id").alias(
            "drug_exposure_id"
        ),
        "person_id",
        F.col("std_concept_id").alias("drug_concept_id"),
        F.col("start").alias("drug_exposure_start_date"),
        F.col("start").alias("drug_exposure_start_datetime"),
        F.col("_end").alias("drug_exposure_end_date"),
        F.col("_end").alias("drug_exposure_end_datetime"),
        F.col("_verbatim").alias("verbatim_end_date"),
        F.col("_type").alias("drug_type_concept_id"),
        F.lit(0).alias("refills"),
        F.lit(0).alias("quantity"),
        F.col("_days").alias("days_supply"),
        F.lit(0).alias("route_concept_id"),
        F.lit("0").alias("lot_number"),
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        F.col("code").alias("drug_source_value"),
        F.col("src_concept_id").alias("drug_source_concept_id"),
    )
    return conform(rows, "drug_exposure")


def measurement(src: Sources) -> DataFrame:
    done = src["procedures"].select("patient", "encounter", "code", _procedure_day(src).alias("day"))
    done = _coded(
        src, done, _standard(src, "Measurement", source_vocabulary_id="SNOMED"), _source(src, ("SNOMED",))
    )
    none = F.lit(None).cast("string")
    done = done.select(
        "*",
        F.lit("p").alias("_kind"),
        none.try_cast("double").alias("value_as_number"),
        F.lit(0).alias("value_as_concept_id"),
        F.lit(0).alias("unit_concept_id"),
        F.col("code").alias("measurement_source_value"),
        none.alias("unit_source_value"),
        none.alias("value_source_value"),
    )
    seen = src["observations"].select("patient", "encounter", "code", F.col("date").alias("day"), "value", "units")
    seen = _coded(
        src, seen, _standard(src, "Measurement", source_vocabulary_id="LOINC"), _source(src, ("LOINC",)), "left"
    )
    units = _standard(src, None, target_vocabulary_id="UCUM", source_vocabulary_id="UCUM")
    units = units.select(F.col("code").alias("units"), F.col("std_concept_id").alias("_unit"))
    answers = _standard(src, "Meas value").select(F.col("code").alias("value"), F.col("std_concept_id").alias("_answer"))
    small = src.vocabulary.small
    seen = lookup_join(lookup_join(seen, units, ["units"], "left", small), answers, ["value"], "left", small)
    seen = seen.select(
        "patient",
        "encounter",
        "code",
        "day",
        "std_concept_id",
        F.coalesce("src_concept_id", F.lit(0)).alias("src_concept_id"),
        F.lit("o").alias("_kind"),
        F.col("value").try_cast("double").alias("value_as_number"),
        F.coalesce("_answer", F.lit(0)).alias("value_as_concept_id"),
        F.coalesce("_unit", F.lit(0)).alias("unit_concept_id"),
        F.substring("value", 1, 50).alias("measurement_source_value"),
        F.col("units").alias("unit_source_value"),
        F.col("value").alias("value_source_value"),
    )
    rows = _in_context(src, done.unionByName(seen)).select(
        _row_id(
            "_kind", "patient", "encounter", "code", "day", "value_source_value", "std_concept_id", "src_concept_id"
        ).alias("measurement_id"),
        "person_id",
        F.col("std_concept_id").alias("measurement_concept_id"),
        F.col("day").alias("measurement_date"),
        F.col("day").alias("measurement_datetime"),
        F.col("day").cast("string").alias("measurement_time"),
        F.lit(TYPE_ENCOUNTER).alias("measurement_type_concept_id"),
        F.lit(0).alias("operator_concept_id"),
        "value_as_number",
        "value_as_concept_id",
        "unit_concept_id",
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        "measurement_source_value",
        F.col("src_concept_id").alias("measurement_source_concept_id"),
        "unit_source_value",
        "value_source_value",
    )
    return conform(rows, "measurement")


def observation(src: Sources) -> DataFrame:
    """Allergies, conditions and observations; the key prefix keeps the three apart."""

    def branch(df: DataFrame, prefix: str, vocabulary_id: str, type_concept: int, text: Column, *more: str) -> DataFrame:
        rows = _coded(
            src,
            df,
            _standard(src, "Observation", target_vocabulary_id=vocabulary_id),
            _source(src, (vocabulary_id,), "Observation"),
        )
        parts = [F.col("patient"), F.coalesce("code", F.lit("")), F.col("day").cast("string")]
        parts += [F.coalesce(F.col(c), F.lit("")) for c in more]
        key = F.concat(F.lit(prefix), F.concat_ws("|", *parts))
        return rows.select(
            "patient",
            "encounter",
            "day",
            "std_concept_id",
            "src_concept_id",
            string_id(key).alias("observation_id"),
            F.lit(type_concept).alias("observation_type_concept_id"),
            text.alias("observation_source_value"),
        )

    allergies = src["allergies"].select("patient", "encounter", "code", F.col("start").alias("day"))
    conditions = src["conditions"].select("patient", "encounter", "code", F.col("start").alias("day"))
    seen = src["observations"].select(
        "patient", "encounter", "code", F.col("date").alias("day"), F.substring("value", 1, 50).alias("_text")
    )
    rows = (
        branch(allergies, "a:", "SNOMED", TYPE_ENCOUNTER, F.col("code"))
        .unionByName(branch(conditions, "c:", "SNOMED", TYPE_OBSERVATION_FROM_EHR, F.col("code")))
        .unionByName(branch(seen, "o:", "LOINC", TYPE_OBSERVATION_FROM_EHR, F.col("_text"), "_text"))
    )
    rows = _in_context(src, rows).select(
        "observation_id",
        "person_id",
        F.col("std_concept_id").alias("observation_concept_id"),
        F.col("day").alias("observation_date"),
        F.col("day").alias("observation_datetime"),
        "observation_type_concept_id",
        F.lit(0).alias("value_as_concept_id"),
        F.lit(0).alias("qualifier_concept_id"),
        F.lit(0).alias("unit_concept_id"),
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        "observation_source_value",
        F.col("src_concept_id").alias("observation_source_concept_id"),
    )
    return conform(rows, "observation")


def procedure_occurrence(src: Sources) -> DataFrame:
    vocabularies = ("SNOMED", "HCPCS") if _is_33(src) else ("SNOMED",)
    standard = _standard(src, "Procedure", target_vocabulary_id="SNOMED", source_vocabulary_id=vocabularies)
    columns = ["patient", "encounter", "code", _procedure_day(src).alias("day")]
    has_stop = "stop" in src["procedures"].columns
    columns.append((F.col("stop") if has_stop else F.lit(None).cast("date")).alias("_stop"))
    rows = _coded(src, src["procedures"].select(*columns), standard, _source(src, vocabularies))
    rows = _in_context(src, rows).select(
        _row_id("patient", "encounter", "code", "day", "_stop", "std_concept_id", "src_concept_id").alias(
            "procedure_occurrence_id"
        ),
        "person_id",
        F.col("std_concept_id").alias("procedure_concept_id"),
        F.col("day").alias("procedure_date"),
        F.col("day").alias("procedure_datetime"),
        F.col("_stop").alias("procedure_end_date"),
        F.col("_stop").alias("procedure_end_datetime"),
        F.lit(TYPE_ENCOUNTER).alias("procedure_type_concept_id"),
        F.lit(0).alias("modifier_concept_id"),
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        F.col("code").alias("procedure_source_value"),
        F.col("src_concept_id").alias("procedure_source_concept_id"),
    )
    return conform(rows, "procedure_occurrence")


def device_exposure(src: Sources) -> DataFrame:
    standard = _standard(src, "Device", target_vocabulary_id="SNOMED", source_vocabulary_id="SNOMED")
    rows = src["devices"].select("patient", "encounter", "code", "start", "stop", "udi")
    rows = _in_context(src, _coded(src, rows, standard, _source(src, ("SNOMED",)))).select(
        _row_id("patient", "encounter", "code", "start", "stop", "udi", "std_concept_id", "src_concept_id").alias(
            "device_exposure_id"
        ),
        "person_id",
        F.col("std_concept_id").alias("device_concept_id"),
        F.col("start").alias("device_exposure_start_date"),
        F.col("start").alias("device_exposure_start_datetime"),
        F.col("stop").alias("device_exposure_end_date"),
        F.col("stop").alias("device_exposure_end_datetime"),
        F.lit(TYPE_ENCOUNTER).alias("device_type_concept_id"),
        F.substring("udi", 1, 50).alias("unique_device_id"),
        "provider_id",
        "visit_occurrence_id",
        "visit_detail_id",
        F.col("code").alias("device_source_value"),
        F.col("src_concept_id").alias("device_source_concept_id"),
    )
    return conform(rows, "device_exposure")


def condition_era(conditions: DataFrame) -> DataFrame:
    return conform(TM.condition_eras(conditions), "condition_era")


def drug_era(exposures: DataFrame, vocabulary: V.Vocabulary) -> DataFrame:
    rows = TM.exposures_by_ingredient(exposures, vocabulary.concept, vocabulary.ancestor)
    return conform(TM.drug_eras(rows), "drug_era")


# --- cost -----------------------------------------------------------------------------------------

_MONEY = "total_charge total_cost total_paid paid_by_payer paid_by_patient".split()


def _event_days(events: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """(cost_event_id, code, person_id, visit_occurrence_id, _day) of the events that lie in a visit."""
    event_id, code, day = names
    return events.select(
        F.col(event_id).alias("cost_event_id"),
        F.col(code).alias("code"),
        "person_id",
        "visit_occurrence_id",
        F.col(day).alias("_day"),
    ).where("visit_occurrence_id IS NOT NULL")


def _plan_days(facts: Sequence[DataFrame], plans: DataFrame) -> DataFrame:
    """(person_id, _day, payer_plan_period_id): the plans that hold a day on which a person has any event, found once."""
    days = reduce(DataFrame.unionByName, [f.select("person_id", "_day") for f in facts]).distinct()
    first, last = "payer_plan_period_start_date", "payer_plan_period_end_date"
    spans = plans.select("person_id", "payer_plan_period_id", first, last)
    return S.written(within_period(days, spans, ["person_id"], "_day", first, last).drop(first, last))


def _asked(facts: DataFrame, visits: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct keys (encounter and ``names``) under which the events' visits ask for costs, written.

    Events that a load could code and place are few beside the source rows, so a bitmap of these keys keeps most source rows out
    of the joins that follow.
    """
    stays = visits.select(F.col("visit_source_value").alias("encounter"), "person_id", "visit_occurrence_id")
    keys = facts.select("visit_occurrence_id", "person_id", *names).distinct()
    return S.written(keyed_join(keys, stays, ["visit_occurrence_id", "person_id"]).select("encounter", *names).distinct())


def _event_costs(src: Sources, visits: DataFrame, procedures: DataFrame, drugs: DataFrame, plan_days: DataFrame) -> DataFrame:
    """Costs of procedures and drugs: encounter claim plus the base cost of the matching source rows.

    The three priced sources are one tagged table that meets the encounters once. Source rows are cut to distinct (encounter,
    code, cost) before they meet the events, so repeated codes in one visit do not multiply.
    """
    sources = [("procedures", "p", "Procedure"), ("immunizations", "i", "Drug"), ("medications", "m", "Drug")]
    priced = [
        src[name].select(
            F.lit(tag).alias("_from"), F.lit(domain).alias("cost_domain_id"), "patient", "encounter", "code", "base_cost"
        )
        for name, tag, domain in sources
    ]
    facts = procedures.withColumn("cost_domain_id", F.lit("Procedure")).unionByName(
        drugs.withColumn("cost_domain_id", F.lit("Drug"))
    )
    names = ["code", "cost_domain_id"]
    priced = may_match(reduce(DataFrame.unionByName, priced), _asked(facts, visits, names), ["encounter", *names]).distinct()
    claims = src["encounters"].select(
        F.col("id").alias("encounter"), "patient", string_id("patient").alias("person_id"), "total_claim_cost", "payer_coverage"
    )
    stays = visits.select(F.col("visit_source_value").alias("encounter"), "person_id", "visit_occurrence_id")
    priced = keyed_join(priced, keyed_join(claims, stays, ["encounter", "person_id"]), ["encounter", "patient"])
    total = F.col("total_claim_cost") + F.col("base_cost")
    rows = keyed_join(facts, priced, ["visit_occurrence_id", "person_id", "code", "cost_domain_id"]).select(
        "_from",
        "cost_domain_id",
        "cost_event_id",
        "person_id",
        "_day",
        total.alias("total_charge"),
        total.alias("total_cost"),
        (F.col("payer_coverage") + F.col("base_cost")).alias("total_paid"),
        F.col("payer_coverage").alias("paid_by_payer"),
        (total - F.col("payer_coverage")).alias("paid_by_patient"),
    )
    rows = keyed_join(rows, plan_days, ["person_id", "_day"], "left")
    return rows.select("_from", "cost_domain_id", "cost_event_id", *_MONEY, "payer_plan_period_id").distinct()


def _condition_cost(src: Sources, visits: DataFrame, facts: DataFrame, plan_days: DataFrame) -> DataFrame:
    """Claim payments per condition. Every side is summed to its join keys first."""
    amount = F.col("amount")
    asked = _asked(facts, visits, ["code"])
    claims = src["claims"].select(
        F.col("id").alias("claimid"),
        "patientid",
        F.col("providerid"),
        F.col("appointmentid").alias("encounter"),
        F.col("primarypatientinsuranceid").alias("payer"),
        F.col("diagnosis1").alias("code"),
        F.col("currentillnessdate").alias("start"),
        F.col("servicedate").alias("_service"),
    )
    claims = S.written(may_match(claims, asked, ["encounter", "code"]).withColumnRenamed("encounter", "appointmentid"))
    paid = may_match(src["claims_transactions"].where(F.col("transfertype").isin("1", "p")), claims, ["claimid"])
    paid = paid.groupBy("claimid", "patientid", "appointmentid", "providerid").agg(
        F.sum(F.when(F.col("transfertype") == "1", amount)).alias("_payer"),
        F.sum(F.when(F.col("transfertype") == "p", amount)).alias("_patient"),
    )
    billed = keyed_join(claims, paid, ["claimid", "patientid", "appointmentid", "providerid"])
    keys = ["patientid", "appointmentid", "providerid", "payer", "code", "start", "_service"]
    billed = billed.groupBy(*keys).agg(F.sum("_payer").alias("_payer"), F.sum("_patient").alias("_patient"))
    billed = billed.withColumnsRenamed({"patientid": "patient", "appointmentid": "encounter", "providerid": "provider"})
    encounters = src["encounters"].select(
        F.col("id").alias("encounter"), "patient", "provider", "payer", F.col("start").alias("_service")
    )
    billed = keyed_join(billed, encounters, ["encounter", "patient", "provider", "payer", "_service"])
    noted = may_match(src["conditions"], asked, ["encounter", "code"]).groupBy("patient", "encounter", "code", "start").agg(F.count(F.lit(1)).alias("_n"))
    rows = keyed_join(billed, noted, ["patient", "encounter", "code", "start"])
    rows = rows.groupBy("patient", "encounter", "code").agg(
        F.sum(F.col("_payer") * F.col("_n")).alias("_payer"), F.sum(F.col("_patient") * F.col("_n")).alias("_patient")
    )
    stays = visits.select(F.col("visit_source_value").alias("encounter"), "person_id", "visit_occurrence_id")
    rows = keyed_join(rows.withColumn("person_id", string_id("patient")), stays, ["encounter", "person_id"])
    rows = keyed_join(facts.distinct(), rows, ["visit_occurrence_id", "person_id", "code"])
    rows = keyed_join(rows, plan_days, ["person_id", "_day"], "left")
    zero = F.lit(0).cast("decimal(18,2)")
    rows = rows.groupBy("cost_event_id", "payer_plan_period_id").agg(
        F.coalesce(F.sum("_payer"), zero).alias("_payer"), F.coalesce(F.sum("_patient"), zero).alias("_patient")
    )
    total = F.col("_payer") + F.col("_patient")
    return rows.select(
        "cost_event_id",
        *[total.alias(n) for n in _MONEY[:3]],
        F.col("_payer").alias("paid_by_payer"),
        F.col("_patient").alias("paid_by_patient"),
        F.col("_payer").alias("paid_by_primary"),
        "payer_plan_period_id",
    )


def cost(
    src: Sources,
    visits: DataFrame,
    procedures: DataFrame,
    drugs: DataFrame,
    conditions: DataFrame,
    plans: DataFrame,
) -> DataFrame:
    procedures = _event_days(procedures, ("procedure_occurrence_id", "procedure_source_value", "procedure_date"))
    drugs = _event_days(drugs, ("drug_exposure_id", "drug_source_value", "drug_exposure_start_date"))
    facts = [procedures, drugs]
    if src.version != "2.7.0":  # the oldest exports have no claims
        conditions = _event_days(conditions, ("condition_occurrence_id", "condition_source_value", "condition_start_date"))
        facts.append(conditions)
    plan_days = _plan_days(facts, plans)
    rows = _event_costs(src, visits, procedures, drugs, plan_days)
    if len(facts) > 2:
        more = _condition_cost(src, visits, conditions, plan_days)
        more = more.withColumns({"cost_domain_id": F.lit("Condition"), "_from": F.lit("c")})
        rows = rows.unionByName(more, allowMissingColumns=True)
    if "paid_by_primary" not in rows.columns:
        rows = rows.withColumn("paid_by_primary", F.lit(None))
    rows = rows.select(
        _row_id("_from", "cost_event_id", "payer_plan_period_id", "total_cost", "paid_by_payer").alias("cost_id"),
        "cost_event_id",
        "cost_domain_id",
        F.lit(TYPE_CLAIM_COST).alias("cost_type_concept_id"),
        F.lit(CURRENCY_USD).alias("currency_concept_id"),
        *_MONEY,
        "paid_by_primary",
        "payer_plan_period_id",
        F.lit(0).alias("revenue_code_concept_id"),
        F.lit("UNKNOWN / UNKNOWN").alias("revenue_code_source_value"),
        F.lit(0).alias("drg_concept_id"),
        F.lit("000").alias("drg_source_value"),
    )
    return conform(rows, "cost")


def cdm_source(vocabulary_table: DataFrame, **facts: str) -> DataFrame:
    """One row about this CDM; the vocabulary version is that of vocabulary 'None'."""
    values = {name: F.lit(value) for name, value in facts.items()}
    today = F.current_date()
    rows = vocabulary_table.where("vocabulary_id = 'None'").select(
        *[v.alias(k) for k, v in values.items()],
        today.alias("source_release_date"),
        today.alias("cdm_release_date"),
        F.lit("v5.4").alias("cdm_version"),
        F.lit(CDM_VERSION_CONCEPT).alias("cdm_version_concept_id"),
        "vocabulary_version",
    )
    return conform(rows, "cdm_source")
