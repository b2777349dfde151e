"""Edges: one staging view (or resolved family) to one CDM table, each a lazy DataFrame.

Rows that several tables share are resolved once per family and routed by the domain of the concept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom import session as S
from medloom.functions import keys as K
from medloom.functions.dates import utc_date, utc_datetime, wall_date, wall_datetime
from medloom.operators import terminology as V
from medloom.operators.flatten import flatten
from medloom.operators.joins import first_per_group, keyed_join, lookup_join
from medloom.plans import views
from medloom.schema.cdm import conform
from medloom.sources import conceptmaps

# Type concepts and other constants of the target tables.
TYPE_EHR = 32817
TYPE_EHR_ENCOUNTER = 32827
TYPE_LAB = 32856
TYPE_PRESCRIPTION_WRITTEN = 38000177
TYPE_DISPENSED = 38000176
TYPE_ADMINISTERED = 38000179
TYPE_REPORTED = 38000178
TYPE_MEDICATION_LIST = 38000175
PERIOD_FROM_ENCOUNTERS = 44814724
FAMILY_PRACTICE = 38004446
ENCODING_UTF8 = 32678
LANGUAGE_ENGLISH = 4180186
PLACE_OF_SERVICE = {"prov": 8940, "dept": 4318944, "edu": 4030303, "govt": 4195901, "team": 4217012}
GENDER_WORDS = {"male": 8507, "female": 8532, "other": 8521, "unknown": 8551}
# Statuses that keep a resource out, after the default for an absent status.
DROPPED = {
    "encounter": ("finished", ["entered-in-error", "cancelled", "planned", "unknown"]),
    "condition": ("confirmed", ["refuted", "entered-in-error"]),
    "procedure": ("completed", ["entered-in-error", "not-done", "unknown"]),
    "observation": ("final", ["entered-in-error", "cancelled", "unknown"]),
    "report": ("final", ["entered-in-error", "cancelled", "unknown"]),
    "allergy": ("confirmed", ["entered-in-error", "refuted"]),
    "request": ("", ["entered-in-error", "cancelled", "draft", "unknown"]),
    "administration": ("completed", ["entered-in-error", "not-done", "unknown"]),
    "immunization": ("completed", ["entered-in-error", "not-done"]),
    "statement": ("active", ["entered-in-error", "cancelled"]),
}


def _kept(status: str, kind: str) -> Column:
    default, dropped = DROPPED[kind]
    return ~F.coalesce(F.col(status), F.lit(default)).isin(*dropped)


def _words(value: Column, table: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(0))


def _left(value: Column, n: int) -> Column:
    return F.substring(value, 1, n)


def _first(*names: str) -> Column:
    return F.coalesce(*[F.col(n) for n in names])


@dataclass
class Context:
    """What the edges read: raw resources, the vocabulary, the concept maps."""

    resources: DataFrame
    vocabulary: V.Vocabulary
    maps: dict[str, DataFrame] = field(default_factory=dict)
    # A gate may narrow the resources of an edge before they are flattened.
    gate: Callable[[DataFrame, str], DataFrame] | None = None
    materialize: bool = False
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def map(self, map_id: str) -> DataFrame:
        if map_id not in self.maps:
            self.maps[map_id] = conceptmaps.built_in(self.resources.sparkSession, map_id, self.vocabulary.concept)
        return self.maps[map_id]

    def staging(self, view: views.View) -> DataFrame:
        key = "view " + view.name
        if key not in self._frames:
            rows = self.resources if self.gate is None else self.gate(self.resources, view.name)
            df = flatten(rows, view)
            # Persons and their addresses read the same view; the other views have one reader.
            shared = self.materialize and view is views.patient
            self._frames[key] = S.checkpointed(df) if shared else df
        return self._frames[key]

    def family(self, name: str, domain: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """A resolved family. Several tables read it, so a full run writes it out once, whole.

        Otherwise a reader may name the only ``domain`` it takes and the ``columns`` of the view that it reads.
        """
        if self.materialize:
            if name not in self._frames:
                self._frames[name] = S.checkpointed(RESOLVED[name](self, None, None))
            return self._frames[name]
        key = repr((name, domain, columns))
        if key not in self._frames:
            self._frames[key] = RESOLVED[name](self, domain, columns)
        return self._frames[key]

    def routed(self, name: str, domain: str) -> DataFrame:
        """The rows of a family whose concepts belong to a domain."""
        return V.route(self.family(name, domain), domain)


# --- resolved families ----------------------------------------------------------------------------


def condition_resolved(ctx: Context, domain: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    preferred = [views.SNOMED, views.ICD10CM, views.ICD9CM, views.ICD10]
    staged = ctx.staging(views.condition)
    return V.resolve_codings(
        staged,
        ctx.vocabulary,
        ctx.map("system_vocabulary"),
        "code_system",
        "code_value",
        ["id"],
        preferred,
        ["code_display"],
        domain,
        columns,
    )


def report_resolved(ctx: Context, domain: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    staged = ctx.staging(views.report).where(_kept("status", "report"))
    return V.resolve_codings(
        staged,
        ctx.vocabulary,
        ctx.map("system_vocabulary"),
        "code_system",
        "code_value",
        ["id"],
        [views.LOINC, views.SNOMED],
        domain=domain,
        columns=columns,
    )


def observation_resolved(ctx: Context, domain: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    has_value = reduce(
        lambda a, b: a | b, [F.col(c).isNotNull() for c in ("value_number", "value_string", "value_code", "value_text")]
    )
    systems = ctx.map("system_vocabulary")
    staged = ctx.staging(views.observation).where(has_value & _kept("status", "observation"))
    values = ["value_code_system", "value_code", "value_unit_code", "value_comparator"]
    rows = V.resolve_codings(
        staged,
        ctx.vocabulary,
        systems,
        "code_system",
        "code_value",
        ["id"],
        [views.LOINC, views.SNOMED],
        domain=domain,
        columns=None if columns is None else [*values, *columns],
    )
    rows = V.coded_answer(rows, ctx.vocabulary, systems, "value_code_system", "value_code")
    rows = V.unit_concept(rows, ctx.vocabulary, "value_unit_code")
    return rows.withColumn("operator_concept_id", V.comparator_concept(F.col("value_comparator")))


def component_resolved(ctx: Context, domain: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    systems = ctx.map("system_vocabulary")
    staged = ctx.staging(views.observation_component)
    staged = staged.where(F.col("component_code").isNotNull() & _kept("status", "observation"))
    answer = ["component_value_code_system", "component_value_code", "component_unit_code"]
    rows = V.resolve_codings(
        staged,
        ctx.vocabulary,
        systems,
        "component_code_system",
        "component_code",
        ["id", "component_code"],
        ties=["component_value_num", "component_value_string", "component_value_code", "component_value_text"],
        domain=domain,
        columns=None if columns is None else [*answer, *columns],
    )
    rows = V.coded_answer(rows, ctx.vocabulary, systems, "component_value_code_system", "component_value_code")
    return V.unit_concept(rows, ctx.vocabulary, "component_unit_code")


RESOLVED: dict[str, Callable[[Context, str | None, Sequence[str] | None], DataFrame]] = {
    "condition": condition_resolved,
    "report": report_resolved,
    "observation": observation_resolved,
    "component": component_resolved,
}

# --- shared shape of event rows -------------------------------------------------------------------

# Table -> prefix of its concept columns and of its date columns.
EVENT_NAMES = {
    "condition_occurrence": ("condition", "condition_start"),
    "procedure_occurrence": ("procedure", "procedure"),
    "measurement": ("measurement", "measurement"),
    "observation": ("observation", "observation"),
    "drug_exposure": ("drug", "drug_exposure_start"),
    "device_exposure": ("device", "device_exposure_start"),
}


def _event(
    df: DataFrame,
    table: str,
    key: Column,
    person: str,
    when: tuple[Column, Column],
    type_concept: Column | int,
    source: Column,
    provider: Column | None = None,
    visit: str | None = None,
    **extra: Column,
) -> DataFrame:
    """One event row per input row: names follow from the table, ``extra`` holds what is particular."""
    concept, date = EVENT_NAMES[table]
    values = {
        f"{table}_id": key,
        "person_id": K.reference_id(person),
        f"{concept}_concept_id": F.col("std_concept_id"),
        f"{date}_date": when[0],
        f"{date}_datetime": when[1],
        f"{concept}_type_concept_id": F.lit(type_concept) if isinstance(type_concept, int) else type_concept,
        f"{concept}_source_value": source,
        f"{concept}_source_concept_id": F.col("src_concept_id"),
        **extra,
    }
    if provider is not None:
        values["provider_id"] = provider
    if visit is not None:
        values["visit_occurrence_id"] = K.reference_id(visit)
    return conform(df.select(*[v.alias(k) for k, v in values.items()]), table)


def _wall(*names: str) -> tuple[Column, Column]:
    return wall_date(_first(*names)), wall_datetime(_first(*names))


# --- Condition ------------------------------------------------------------------------------------


def _condition_rows(ctx: Context, domain: str) -> DataFrame:
    return ctx.routed("condition", domain).where(_kept("verification_status_code", "condition"))


def _condition_event(df: DataFrame, table: str, type_concept: Column | int, **extra: Column) -> DataFrame:
    return _event(
        df,
        table,
        K.coded_id("id", "std_concept_id"),
        "subject_ref",
        _wall("onset_dt", "onset_period_start", "recorded_date"),
        type_concept,
        _left(_first("code_display", "code_value", "code_text"), 50),
        F.coalesce(K.reference_id("asserter_ref"), K.reference_id("recorder_ref")),
        "encounter_ref",
        **extra,
    )


def condition_occurrence(ctx: Context) -> DataFrame:
    df = _condition_rows(ctx, "Condition")
    for name, source in (
        ("clinical_status", "clinical_status_code"),
        ("verification_status", "verification_status_code"),
        ("condition_category", "category_code"),
    ):
        df = conceptmaps.attach(df, ctx.map(name), F.col(source), **{f"_{name}": "concept_id"})
    stated = [F.nullif(F.col(c), F.lit(0)) for c in ("_verification_status", "_clinical_status")]
    end = _wall("abatement_dt", "abatement_period_end")
    return _condition_event(
        df,
        "condition_occurrence",
        F.coalesce(F.col("_condition_category"), F.lit(TYPE_EHR)),
        condition_end_date=end[0],
        condition_end_datetime=end[1],
        condition_status_concept_id=F.coalesce(*stated, F.lit(0)),
        stop_reason=_left(F.col("abatement_string"), 20),
        condition_status_source_value=_left(F.col("clinical_status_code"), 50),
    )


def condition_procedure(ctx: Context) -> DataFrame:
    return _condition_event(_condition_rows(ctx, "Procedure"), "procedure_occurrence", TYPE_EHR_ENCOUNTER)


def condition_measurement(ctx: Context) -> DataFrame:
    return _condition_event(_condition_rows(ctx, "Measurement"), "measurement", TYPE_EHR_ENCOUNTER)


def condition_observation(ctx: Context) -> DataFrame:
    return _condition_event(_condition_rows(ctx, "Observation"), "observation", TYPE_EHR_ENCOUNTER)


# --- Observation and its components ---------------------------------------------------------------


def _observed(df: DataFrame, table: str, key: Column, source: Column, **extra: Column) -> DataFrame:
    return _event(
        df,
        table,
        key,
        "subject_id",
        _wall("effective_dt", "effective_period_start"),
        TYPE_EHR,
        _left(source, 50),
        K.reference_id("performer_id"),
        "encounter_id",
        value_as_concept_id=F.col("value_as_concept_id"),
        unit_concept_id=F.col("unit_concept_id"),
        **extra,
    )


def observation_measurement(ctx: Context) -> DataFrame:
    return _observed(
        ctx.routed("observation", "Measurement"),
        "measurement",
        K.coded_id("id", "std_concept_id"),
        _first("code_value", "code_text"),
        operator_concept_id=F.col("operator_concept_id"),
        value_as_number=F.col("value_number"),
        range_low=F.col("range_low"),
        range_high=F.col("range_high"),
        unit_source_value=_left(F.col("value_unit_text"), 50),
        value_source_value=_left(F.col("value_text"), 50),
    )


def observation_observation(ctx: Context) -> DataFrame:
    return _observed(
        ctx.routed("observation", "Observation"),
        "observation",
        K.coded_id("id", "std_concept_id"),
        _first("code_value", "code_text"),
        value_as_number=F.col("value_number"),
        value_as_string=_left(F.col("value_string"), 60),
        unit_source_value=_left(F.col("value_unit_text"), 50),
        qualifier_source_value=_left(F.col("qualifier_code"), 50),
        value_source_value=_left(F.col("value_text"), 50),
    )


def component_measurement(ctx: Context) -> DataFrame:
    rows = ctx.routed("component", "Measurement").where("component_value_num IS NOT NULL")
    return _observed(
        rows,
        "measurement",
        K.component_id("id", "component_code", "std_concept_id", "/"),
        _first("component_code", "component_code_text"),
        value_as_number=F.col("component_value_num"),
        unit_source_value=_left(F.col("component_unit_text"), 50),
    )


def component_observation(ctx: Context) -> DataFrame:
    return _observed(
        ctx.routed("component", "Observation"),
        "observation",
        K.component_id("id", "component_code", "std_concept_id", "/o/"),
        _first("component_code", "component_code_text"),
        value_as_number=F.col("component_value_num"),
        value_as_string=_left(_first("component_value_text", "component_value_string"), 60),
        unit_source_value=_left(F.col("component_unit_text"), 50),
        value_source_value=_left(
            _first("component_value_text", "component_value_string", "component_value_code"), 50
        ),
    )


# --- DiagnosticReport -----------------------------------------------------------------------------


def _report_event(ctx: Context, domain: str, table: str, type_concept: int, **extra: Column) -> DataFrame:
    return _event(
        ctx.routed("report", domain),
        table,
        K.coded_id("id", "std_concept_id"),
        "subject_ref",
        _wall("effective_dt"),
        type_concept,
        _left(_first("code_value", "code_text"), 50),
        K.reference_id("performer_practitioner_ref"),
        "encounter_ref",
        **extra,
    )


def report_measurement(ctx: Context) -> DataFrame:
    return _report_event(ctx, "Measurement", "measurement", TYPE_LAB)


def report_observation(ctx: Context) -> DataFrame:
    return _report_event(
        ctx, "Observation", "observation", TYPE_EHR, value_source_value=_left(F.col("code_text"), 50)
    )


def report_procedure(ctx: Context) -> DataFrame:
    return _report_event(ctx, "Procedure", "procedure_occurrence", TYPE_EHR_ENCOUNTER)


def report_note(ctx: Context) -> DataFrame:
    texts = ("presented_data", "conclusion", "code_text")
    some_text = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in texts])
    df = ctx.staging(views.report_note)
    df = df.where(F.col("effective_dt").isNotNull() & some_text & _kept("status", "report"))
    df = V.code_in_vocabulary(df, ctx.vocabulary, "LOINC", "code_loinc", "_class")
    # attachments that are not UTF-8 text (scans, for example) have no body
    body = F.try_validate_utf8(F.try_to_binary(F.col("presented_data"), F.lit("base64")).cast("string"))
    when = _wall("effective_dt")
    values = {
        "note_id": K.reference_id("id"),
        "person_id": K.reference_id("subject_ref"),
        "note_date": when[0],
        "note_datetime": when[1],
        "note_type_concept_id": F.lit(TYPE_EHR),
        "note_class_concept_id": F.coalesce(F.col("_class"), F.lit(0)),
        "note_title": _left(F.col("code_text"), 250),
        "note_text": F.coalesce(body, F.col("conclusion"), F.col("code_text"), F.lit("")),
        "encoding_concept_id": F.lit(ENCODING_UTF8),
        "language_concept_id": F.lit(LANGUAGE_ENGLISH),
        "provider_id": K.reference_id("performer_practitioner_ref"),
        "visit_occurrence_id": K.reference_id("encounter_ref"),
        "note_source_value": _left(F.col("code_loinc"), 50),
    }
    return _project(df, "note", values)


def _project(df: DataFrame, table: str, values: dict[str, Column]) -> DataFrame:
    return conform(df.select(*[v.alias(k) for k, v in values.items()]), table)


# --- people and places ----------------------------------------------------------------------------


def provider(ctx: Context) -> DataFrame:
    word = F.lower(F.coalesce(F.col("gender"), F.lit("")))
    stated = {k: GENDER_WORDS[k] for k in ("male", "female")}
    values = {
        "provider_id": K.string_id("id"),
        "provider_name": F.concat(
            F.coalesce(F.col("family"), F.lit("")), F.lit(", "), F.coalesce(F.col("given"), F.lit(""))
        ),
        "npi": F.col("npi"),
        "specialty_concept_id": F.lit(FAMILY_PRACTICE),
        "gender_concept_id": _words(word, GENDER_WORDS),
        "provider_source_value": F.col("id"),
        "specialty_source_concept_id": F.lit(FAMILY_PRACTICE),
        "gender_source_value": F.col("gender"),
        "gender_source_concept_id": _words(word, stated),
    }
    return _project(ctx.staging(views.practitioner), "provider", values)


def provider_with_roles(ctx: Context, providers: DataFrame | None = None) -> DataFrame:
    """Providers with specialty and care site from their roles; values without a role value stay.

    Of several roles the one with the lowest specialty concept, then care site, is taken.
    """
    roles = V.code_in_vocabulary(
        ctx.staging(views.practitioner_role), ctx.vocabulary, "SNOMED", "specialty_code", "_specialty"
    )
    roles = roles.select(
        K.reference_id("practitioner_ref").alias("provider_id"),
        F.struct(
            F.col("_specialty").isNull().alias("none"),
            F.col("_specialty").alias("specialty"),
            K.reference_id("org_ref").isNull().alias("no_site"),
            K.reference_id("org_ref").alias("site"),
        ).alias("_role"),
    ).where("provider_id IS NOT NULL")
    roles = roles.groupBy("provider_id").agg(F.min("_role").alias("_role"))
    base = providers if providers is not None else provider(ctx)
    joined = base.join(roles, "provider_id", "left")
    updated = joined.withColumn(
        "specialty_concept_id", F.coalesce(F.col("_role.specialty"), F.col("specialty_concept_id"))
    ).withColumn("care_site_id", F.coalesce(F.col("_role.site"), F.col("care_site_id")))
    return conform(updated.drop("_role"), "provider")


def organization_care_site(ctx: Context) -> DataFrame:
    values = {
        "care_site_id": K.string_id("id"),
        "care_site_name": F.col("name"),
        "place_of_service_concept_id": _words(F.coalesce(F.col("type_code"), F.lit("")), PLACE_OF_SERVICE),
        "care_site_source_value": F.col("id"),
        "place_of_service_source_value": F.col("type_code"),
    }
    return _project(ctx.staging(views.organization), "care_site", values)


def location_care_site(ctx: Context) -> DataFrame:
    values = {
        "care_site_id": K.reference_id("id"),
        "care_site_name": _left(F.col("name"), 255),
        "place_of_service_concept_id": F.lit(0),
        "location_id": K.reference_id("id"),
        "care_site_source_value": F.col("id"),
        "place_of_service_source_value": _left(F.col("type_code"), 50),
    }
    return _project(ctx.staging(views.location_care_site), "care_site", values)


_ADDRESS = ("location_line", "location_city", "location_state", "location_zip")


def patient_location(ctx: Context) -> DataFrame:
    """One row per address. Among patients at one address the first by country and position stands for it."""
    some_part = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in _ADDRESS])
    df = ctx.staging(views.patient).where(some_part).withColumn("location_id", K.address_id(*_ADDRESS))
    order = [F.col(c).asc_nulls_last() for c in (*_ADDRESS, "location_county", "location_country")]
    order += [F.col(c).asc_nulls_last() for c in ("location_lat", "location_lng")]
    df = first_per_group(df, ["location_id"], order)
    df = conceptmaps.attach(df, ctx.map("country"), F.col("location_country"), _country="concept_id")
    values = {
        "location_id": F.col("location_id"),
        "address_1": F.col("location_line"),
        "city": F.col("location_city"),
        "state": F.col("location_state"),
        "zip": F.col("location_zip"),
        "county": F.col("location_county"),
        "location_source_value": _left(
            F.concat_ws(", ", *[F.nullif(F.col(c), F.lit("")) for c in _ADDRESS]), 50
        ),
        "country_concept_id": F.coalesce(F.col("_country"), F.lit(0)),
        "country_source_value": F.col("location_country"),
        "latitude": F.col("location_lat"),
        "longitude": F.col("location_lng"),
    }
    return _project(df, "location", values)


def location_location(ctx: Context) -> DataFrame:
    df = ctx.staging(views.location)
    df = conceptmaps.attach(df, ctx.map("country"), F.col("country"), _country="concept_id")
    values = {
        "location_id": K.reference_id("id"),
        "address_1": _left(F.col("line"), 50),
        "city": _left(F.col("city"), 50),
        "zip": _left(F.col("zip"), 9),
        "location_source_value": _left(F.col("state"), 50),
        "country_concept_id": F.coalesce(F.col("_country"), F.lit(0)),
        "country_source_value": _left(F.col("country"), 80),
        "latitude": F.col("lat"),
        "longitude": F.col("lng"),
    }
    return _project(df, "location", values)


def person(ctx: Context) -> DataFrame:
    df = ctx.staging(views.patient).withColumn("_sex", _first("us_core_birthsex", "gender"))
    df = conceptmaps.attach(df, ctx.map("gender"), F.col("_sex"), _g="concept_id", _gs="source_concept_id")
    df = conceptmaps.attach(
        df, ctx.map("race_category"), F.col("race_omb_code"), _r="concept_id", _rs="source_concept_id"
    )
    df = conceptmaps.attach(df, ctx.map("race_text"), F.col("race_text"), _rt="concept_id")
    df = conceptmaps.attach(
        df, ctx.map("ethnicity_category"), F.col("ethnicity_omb_code"), _e="concept_id", _es="source_concept_id"
    )
    born = wall_date(F.col("birth_date"))
    zero = F.lit(0)
    # A native race concept wins, then the free text of an unknown category, then the category itself.
    race = F.coalesce(
        F.col("omop_race_code").try_cast("int"),
        F.when(F.col("race_omb_code") == "UNK", F.col("_rt")),
        F.col("_r"),
        zero,
    )
    values = {
        "person_id": K.string_id("id"),
        "gender_concept_id": F.coalesce(F.col("_g"), zero),
        "year_of_birth": F.year(born),
        "month_of_birth": F.month(born),
        "day_of_birth": F.dayofmonth(born),
        "birth_datetime": F.coalesce(wall_datetime(F.col("birth_time")), wall_datetime(F.col("birth_date"))),
        "race_concept_id": race,
        "ethnicity_concept_id": F.coalesce(F.col("omop_ethnicity_code").try_cast("int"), F.col("_e"), zero),
        "location_id": K.address_id(*_ADDRESS),
        "provider_id": K.reference_id("general_practitioner_ref"),
        "care_site_id": K.reference_id("managing_organization_ref"),
        "person_source_value": F.col("id"),
        "gender_source_value": F.col("_sex"),
        "gender_source_concept_id": F.coalesce(F.col("_gs"), zero),
        "race_source_value": _first("omop_race_display", "race_text"),
        "race_source_concept_id": F.coalesce(F.col("_rs"), zero),
        "ethnicity_source_value": _first("omop_ethnicity_display", "ethnicity_text"),
        "ethnicity_source_concept_id": F.coalesce(F.col("_es"), zero),
    }
    return _project(df, "person", values)


def death(ctx: Context) -> DataFrame:
    df = ctx.staging(views.patient_death).where("death_dt IS NOT NULL")
    values = {
        "person_id": K.reference_id("id"),
        "death_date": wall_date(F.col("death_dt")),
        "death_datetime": wall_datetime(F.col("death_dt")),
        "death_type_concept_id": F.lit(TYPE_EHR),
    }
    return _project(df, "death", values)


def visit_occurrence(ctx: Context) -> DataFrame:
    df = ctx.staging(views.encounter).where(_kept("status", "encounter"))
    df = conceptmaps.attach(df, ctx.map("encounter_class"), F.col("class_code"), _class="concept_id")
    end = _first("period_end", "period_start")
    values = {
        "visit_occurrence_id": K.reference_id("id"),
        "person_id": K.reference_id("subject_ref"),
        "visit_concept_id": F.coalesce(F.col("_class"), F.lit(0)),
        "visit_start_date": utc_date(F.col("period_start")),
        "visit_start_datetime": utc_datetime(F.col("period_start")),
        "visit_end_date": utc_date(end),
        "visit_end_datetime": utc_datetime(end),
        "visit_type_concept_id": F.lit(TYPE_EHR_ENCOUNTER),
        "provider_id": K.reference_id("performer_ref"),
        "care_site_id": K.reference_id("service_provider_ref"),
        "visit_source_value": F.col("id"),
        "visit_source_concept_id": F.lit(0),
        "admitted_from_concept_id": F.lit(0),
        "admitted_from_source_value": F.col("admit_source_code"),
        "discharged_to_concept_id": F.lit(0),
        "discharged_to_source_value": F.col("discharge_disposition_code"),
        "preceding_visit_occurrence_id": K.reference_id("part_of_ref"),
    }
    return _project(df, "visit_occurrence", values)


def observation_period(ctx: Context, visits: DataFrame | None = None) -> DataFrame:
    """First visit start to last visit end of every patient with a visit. Visits are reduced before the join."""
    visits = visits if visits is not None else visit_occurrence(ctx)
    spans = visits.groupBy("person_id").agg(
        F.min("visit_start_date").alias("observation_period_start_date"),
        F.max("visit_end_date").alias("observation_period_end_date"),
    )
    patients = ctx.staging(views.patient_observation_period).select(K.reference_id("id").alias("person_id"))
    df = patients.distinct().join(spans, "person_id").withColumn("observation_period_id", F.col("person_id"))
    return conform(df.withColumn("period_type_concept_id", F.lit(PERIOD_FROM_ENCOUNTERS)), "observation_period")


def payer_plan_period(ctx: Context) -> DataFrame:
    df = ctx.staging(views.coverage).where("period_start IS NOT NULL OR period_end IS NOT NULL")
    values = {
        "payer_plan_period_id": K.reference_id("id"),
        "person_id": K.reference_id("subject_ref"),
        "payer_plan_period_start_date": wall_date(_first("period_start", "period_end")),
        "payer_plan_period_end_date": wall_date(_first("period_end", "period_start")),
        "payer_source_value": _left(F.col("payer_name"), 50),
        "plan_source_value": _left(F.col("type_text"), 50),
        **{f"{c}_concept_id": F.lit(0) for c in ("payer", "plan", "sponsor", "stop_reason")},
    }
    return _project(df, "payer_plan_period", values)


# --- events with a code per resource --------------------------------------------------------------


def procedure_occurrence(ctx: Context) -> DataFrame:
    codes = [("SNOMED", "code_snomed"), ("CPT4", "code_cpt4"), ("HCPCS", "code_hcpcs"), ("ICD10PCS", "code_icd10pcs")]
    staged = ctx.staging(views.procedure).where(_kept("status", "procedure"))
    df = V.resolve_priority(staged, ctx.vocabulary, codes, "Procedure")
    start, end = _first("performed_dt", "performed_period_start"), F.col("performed_period_end")
    return _event(
        df,
        "procedure_occurrence",
        K.reference_id("id"),
        "subject_ref",
        (utc_date(start), utc_datetime(start)),
        TYPE_EHR_ENCOUNTER,
        F.col("src_code"),
        K.reference_id("performer_ref"),
        "encounter_ref",
        procedure_end_date=utc_date(end),
        procedure_end_datetime=utc_datetime(end),
    )


def allergy_observation(ctx: Context) -> DataFrame:
    codes = [("SNOMED", "code_snomed"), ("RxNorm", "code_rxnorm")]
    staged = ctx.staging(views.allergy_observation).where(_kept("verify_status", "allergy"))
    return _event(
        V.resolve_priority(staged, ctx.vocabulary, codes, None),
        "observation",
        K.reference_id("id"),
        "subject_ref",
        _wall("recorded_date", "onset_dt"),
        TYPE_EHR,
        _left(F.col("src_code"), 50),
        None,
        "encounter_ref",
        value_as_concept_id=F.col("std_concept_id"),
        qualifier_source_value=_left(F.col("status_code"), 50),
        value_source_value=_left(F.col("code_text"), 50),
    )


def _drug(
    df: DataFrame, type_concept: int, start: Sequence[str], end: Sequence[str] | None = None, **extra: Column
) -> DataFrame:
    stop = _wall(*(end or start))
    return _event(
        df,
        "drug_exposure",
        K.reference_id("id"),
        "subject_ref",
        _wall(*start),
        type_concept,
        _left(F.col("src_code"), 50),
        extra.pop("provider_id", None),
        "encounter_ref",
        drug_exposure_end_date=stop[0],
        drug_exposure_end_datetime=stop[1],
        **extra,
    )


_DRUG_CODES = [("RxNorm", "drug_rxnorm"), ("NDC", "drug_ndc")]
_DRUG_CODES_NAMED_CODE = [("RxNorm", "code_rxnorm"), ("NDC", "code_ndc")]


def medication_request(ctx: Context) -> DataFrame:
    staged = ctx.staging(views.medication_request).where(_kept("status", "request"))
    df = V.resolve_priority(staged, ctx.vocabulary, _DRUG_CODES_NAMED_CODE, "Drug")
    return _drug(df, TYPE_PRESCRIPTION_WRITTEN, ["authored_on"], provider_id=K.reference_id("requester_ref"))


def medication_administration(ctx: Context) -> DataFrame:
    staged = ctx.staging(views.medication_administration).where(_kept("status_code", "administration"))
    codes = [*_DRUG_CODES_NAMED_CODE, ("SNOMED", "code_snomed")]
    return _drug(V.resolve_priority(staged, ctx.vocabulary, codes, "Drug"), TYPE_ADMINISTERED, ["effective_dt"])


def medication_dispense(ctx: Context) -> DataFrame:
    df = V.resolve_priority(ctx.staging(views.medication_dispense), ctx.vocabulary, _DRUG_CODES, "Drug")
    return _drug(
        df,
        TYPE_DISPENSED,
        ["dispense_dt"],
        quantity=F.col("quantity_value"),
        days_supply=F.col("days_supply"),
    )


def medication_statement(ctx: Context) -> DataFrame:
    staged = ctx.staging(views.medication_statement).where(_kept("status_code", "statement"))
    df = V.resolve_priority(staged, ctx.vocabulary, _DRUG_CODES, "Drug")
    return _drug(
        df, TYPE_REPORTED, ["effective_dt", "period_start"], ["period_end", "effective_dt", "period_start"]
    )


def immunization(ctx: Context) -> DataFrame:
    staged = ctx.staging(views.immunization).where(_kept("status", "immunization"))
    codes = [("CVX", "code_cvx"), ("RxNorm", "code_rxnorm")]
    df = V.resolve_priority(staged, ctx.vocabulary, codes, "Drug", keep_unmapped=True)
    return _drug(df, TYPE_EHR_ENCOUNTER, ["occurrence_dt"])


def medication(ctx: Context) -> DataFrame:
    """A Medication names no patient, so it yields no exposure; the shape is kept for callers."""
    df = V.resolve_priority(ctx.staging(views.medication), ctx.vocabulary, _DRUG_CODES, "Drug")
    values = {
        "drug_exposure_id": K.reference_id("id"),
        "drug_concept_id": F.col("std_concept_id"),
        "drug_exposure_start_date": F.current_date(),
        "drug_exposure_end_date": F.current_date(),
        "drug_type_concept_id": F.lit(TYPE_MEDICATION_LIST),
        "drug_source_value": _left(F.col("src_code"), 50),
        "drug_source_concept_id": F.col("src_concept_id"),
    }
    return _project(df.where(F.lit(False)), "drug_exposure", values)


def device_exposure(ctx: Context) -> DataFrame:
    """A code with several standard devices gives several rows."""
    vocabulary = ctx.vocabulary
    side = vocabulary.maps.where("vocabulary_id = 'SNOMED' AND std_domain = 'Device'")
    side = side.select(F.col("concept_code").alias("code_snomed"), "src_concept_id", "std_concept_id")
    staged = ctx.staging(views.device).where(F.col("status_code").isin("active", "inactive"))
    end = _wall("expiration_date")
    return _event(
        lookup_join(staged, side, ["code_snomed"], "inner", vocabulary.small),
        "device_exposure",
        K.reference_id("id"),
        "subject_ref",
        _wall("manufacture_date"),
        TYPE_EHR,
        _left(F.col("code_snomed"), 50),
        device_exposure_end_date=end[0],
        device_exposure_end_datetime=end[1],
        unique_device_id=_left(F.col("udi"), 255),
        production_id=_left(F.col("lot_number"), 255),
    )


def specimen(ctx: Context) -> DataFrame:
    df = ctx.staging(views.specimen).where("collected_dt IS NOT NULL")
    df = V.code_in_vocabulary(df, ctx.vocabulary, "SNOMED", "type_snomed", "_kind", "Specimen")
    df = V.code_in_vocabulary(df, ctx.vocabulary, "SNOMED", "body_site_snomed", "_site")
    when = _wall("collected_dt")
    values = {
        "specimen_id": K.reference_id("id"),
        "person_id": K.reference_id("subject_ref"),
        "specimen_concept_id": F.coalesce(F.col("_kind"), F.lit(0)),
        "specimen_type_concept_id": F.lit(TYPE_LAB),
        "specimen_date": when[0],
        "specimen_datetime": when[1],
        "quantity": F.col("quantity_value"),
        "anatomic_site_concept_id": F.coalesce(F.col("_site"), F.lit(0)),
        "specimen_source_value": _left(F.col("type_snomed"), 50),
        "anatomic_site_source_value": _left(F.col("body_site_snomed"), 50),
    }
    return _project(df, "specimen", values)


def rekey(df: DataFrame, remap: DataFrame, column: str) -> DataFrame:
    """Replace an old key by its new one; rows without an entry keep theirs. ``remap`` is ``(old_id, new_id)``."""
    side = remap.select(F.col("old_id").alias(column), F.col("new_id").alias("_new"))
    order = df.columns
    joined = keyed_join(df, side, [column], "left")
    return joined.withColumn(column, F.coalesce(F.col("_new"), F.col(column))).select(*order)


def rekey_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Move person, visit and care site keys of existing tables to hashes of their source values."""
    owners = {
        "person_id": ("person", "person_source_value"),
        "visit_occurrence_id": ("visit_occurrence", "visit_source_value"),
        "care_site_id": ("care_site", "care_site_source_value"),
    }
    out = dict(tables)
    for column, (owner, source) in owners.items():
        if owner not in tables:
            continue
        remap = tables[owner].select(F.col(column).alias("old_id"), K.string_id(source).alias("new_id"))
        for name, df in tables.items():
            if column in df.columns:
                out[name] = rekey(out[name], remap, column)
    return out
