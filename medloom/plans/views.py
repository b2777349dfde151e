"""The shipped views: which elements of each resource become which staging column."""

from __future__ import annotations

from medloom.functions.paths import Node
from medloom.operators.flatten import Col, Columns, ForEach, Path, View

# Code systems and extension addresses of the FHIR standard.
SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
RXNORM = "http://www.nlm.nih.gov/research/umls/rxnorm"
ICD10CM = "http://hl7.org/fhir/sid/icd-10-cm"
ICD9CM = "http://hl7.org/fhir/sid/icd-9-cm"
ICD10 = "http://hl7.org/fhir/sid/icd-10"
ICD10PCS = "http://hl7.org/fhir/sid/icd-10-pcs"
NDC = "http://hl7.org/fhir/sid/ndc"
CVX = "http://hl7.org/fhir/sid/cvx"
CPT4 = "http://www.ama-assn.org/go/cpt"
HCPCS = "https://www.cms.gov/Medicare/Coding/HCPCSReleaseCodeSets"
US_NPI = "http://hl7.org/fhir/sid/us-npi"
US_CORE_RACE = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"
US_CORE_ETHNICITY = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity"
US_CORE_BIRTHSEX = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-birthsex"
BIRTH_TIME = "http://hl7.org/fhir/StructureDefinition/patient-birthTime"
GEOLOCATION = "http://hl7.org/fhir/StructureDefinition/geolocation"
OMOP_RACE_NAME = "/omop-race"
OMOP_ETHNICITY_NAME = "/omop-ethnicity"


def _at(path: str) -> Path:
    return lambda n: n.get(path)


def _ref(path: str) -> Path:
    return lambda n: n.get(path).reference_key()


def _first_ref(path: str) -> Path:
    return lambda n: n.get(path).first().reference_key()


def _performer(resource: str) -> Path:
    return lambda n: n.get("performer").where_prefix("reference", resource + "/").first().reference_key()


def _as(base: str, kind: str, inner: str = "") -> Path:
    if inner:
        return lambda n: n.choice(base, kind).get(inner)
    return lambda n: n.choice(base, kind)


def _code(path: str, system: str) -> Path:
    return lambda n: n.get(path).lookup(system)


def _first_coding(path: str, member: str = "code") -> Path:
    return lambda n: n.get(path).first().get("coding").first().get(member)


def _coding(path: str, member: str = "code") -> Path:
    return lambda n: n.get(path).get("coding").first().get(member)


def _cols(*cols: tuple) -> Columns:
    return Columns(tuple(Col(*c) for c in cols))


_ID = ("id", _at("id"), "id")
_STATUS = ("status", _at("status"), "code")
_SUBJECT = ("subject_ref", _ref("subject"))
_PATIENT = ("subject_ref", _ref("patient"))
_ENCOUNTER = ("encounter_ref", _ref("encounter"))
_CONTEXT = ("encounter_ref", _ref("context"))
_TEXT = ("code_text", _at("code.text"))
_EACH_CODING = _cols(
    ("code_system", _at("system"), "uri"), ("code_value", _at("code"), "code"), ("code_display", _at("display"))
)
_DRUG = "medicationCodeableConcept"
_DRUG_TEXT = ("code_text", _at(_DRUG + ".text"))
_DRUG_CODES = (("drug_rxnorm", _code(_DRUG, RXNORM), "code"), ("drug_ndc", _code(_DRUG, NDC), "code"))
_EFFECTIVE = ("effective_dt", _as("effective", "dateTime"), "dateTime")
_EFFECTIVE_START = ("effective_period_start", _as("effective", "Period", "start"), "dateTime")
_OBSERVATION_HEAD = (
    _ID,
    _STATUS,
    ("subject_id", _ref("subject")),
    ("encounter_id", _ref("encounter")),
    ("performer_id", _first_ref("performer")),
)

allergy_observation = View(
    "AllergyIntolerance__observation",
    "AllergyIntolerance",
    (
        _cols(
            _ID,
            _PATIENT,
            _ENCOUNTER,
            ("code_snomed", _code("code", SNOMED), "code"),
            ("code_rxnorm", _code("code", RXNORM), "code"),
            _TEXT,
            ("recorded_date", _at("recordedDate"), "dateTime"),
            ("onset_dt", _as("onset", "dateTime"), "dateTime"),
            ("status_code", _coding("clinicalStatus"), "code"),
            ("verify_status", _coding("verificationStatus"), "code"),
        ),
    ),
)

condition = View(
    "Condition__condition_occurrence",
    "Condition",
    (
        _cols(
            _ID,
            _SUBJECT,
            _ENCOUNTER,
            ("recorder_ref", _ref("recorder")),
            ("asserter_ref", _ref("asserter")),
            _TEXT,
            ("category_code", _first_coding("category"), "code"),
            ("onset_dt", _as("onset", "dateTime"), "dateTime"),
            ("onset_period_start", _as("onset", "Period", "start"), "dateTime"),
            ("recorded_date", _at("recordedDate"), "dateTime"),
            ("abatement_dt", _as("abatement", "dateTime"), "dateTime"),
            ("abatement_period_end", _as("abatement", "Period", "end"), "dateTime"),
            ("abatement_string", _as("abatement", "string")),
            ("clinical_status_code", _coding("clinicalStatus"), "code"),
            ("verification_status_code", _coding("verificationStatus"), "code"),
        ),
        ForEach(lambda n: n.get("code.coding").union(n.get("evidence.concept.coding")), (_EACH_CODING,)),
    ),
)

coverage = View(
    "Coverage__payer_plan_period",
    "Coverage",
    (
        _cols(
            _ID,
            ("subject_ref", _ref("beneficiary")),
            ("period_start", _at("period.start"), "dateTime"),
            ("period_end", _at("period.end"), "dateTime"),
            ("payer_name", lambda n: n.get("payor").first().get("display")),
            ("type_text", _at("type.text")),
        ),
    ),
)

device = View(
    "Device__device_exposure",
    "Device",
    (
        _cols(
            _ID,
            _PATIENT,
            ("code_snomed", _code("type", SNOMED), "code"),
            ("code_text", _at("type.text")),
            ("udi", lambda n: n.get("udiCarrier").first().get("deviceIdentifier")),
            ("lot_number", _at("lotNumber")),
            ("status_code", _at("status"), "code"),
            ("manufacture_date", _at("manufactureDate"), "dateTime"),
            ("expiration_date", _at("expirationDate"), "dateTime"),
        ),
    ),
)

report = View(
    "DiagnosticReport__measurement",
    "DiagnosticReport",
    (
        _cols(
            _ID,
            _STATUS,
            _SUBJECT,
            _ENCOUNTER,
            ("performer_practitioner_ref", _performer("Practitioner")),
            _TEXT,
            _EFFECTIVE,
        ),
        ForEach(_at("code.coding"), (_EACH_CODING,)),
    ),
)

report_note = View(
    "DiagnosticReport__note",
    "DiagnosticReport",
    (
        _cols(
            _ID,
            _STATUS,
            _SUBJECT,
            _ENCOUNTER,
            ("performer_ref", _first_ref("performer")),
            ("performer_practitioner_ref", _performer("Practitioner")),
            ("performer_organization_ref", _performer("Organization")),
            ("code_loinc", _code("code", LOINC), "code"),
            _TEXT,
            _EFFECTIVE,
            ("presented_data", lambda n: n.get("presentedForm").first().get("data"), "base64Binary"),
            ("conclusion", _at("conclusion")),
        ),
    ),
)

encounter = View(
    "Encounter__visit_occurrence",
    "Encounter",
    (
        _cols(
            _ID,
            _STATUS,
            _SUBJECT,
            ("class_code", _at("class.code"), "code"),
            ("class_system", _at("class.system"), "uri"),
            ("type_code", _first_coding("type"), "code"),
            ("type_system", _first_coding("type", "system"), "uri"),
            ("period_start", _at("period.start"), "dateTime"),
            ("period_end", _at("period.end"), "dateTime"),
            ("service_provider_ref", _ref("serviceProvider")),
            ("performer_ref", lambda n: n.get("participant").first().get("individual").reference_key()),
            ("part_of_ref", _ref("partOf")),
            ("admit_source_code", _coding("hospitalization.admitSource"), "code"),
            ("discharge_disposition_code", _coding("hospitalization.dischargeDisposition"), "code"),
        ),
    ),
)

immunization = View(
    "Immunization__drug_exposure",
    "Immunization",
    (
        _cols(
            _ID,
            _STATUS,
            _PATIENT,
            _ENCOUNTER,
            ("code_cvx", _code("vaccineCode", CVX), "code"),
            ("code_rxnorm", _code("vaccineCode", RXNORM), "code"),
            ("code_text", _at("vaccineCode.text")),
            ("occurrence_dt", _as("occurrence", "dateTime"), "dateTime"),
            ("status_code", _at("status"), "code"),
        ),
    ),
)

location_care_site = View(
    "Location__care_site",
    "Location",
    (
        _cols(
            _ID,
            ("name", _at("name")),
            ("type_code", lambda n: n.get("type").first().lookup(SNOMED), "code"),
        ),
    ),
)

location = View(
    "Location__location",
    "Location",
    (
        _cols(
            _ID,
            ("line", lambda n: n.get("address.line").join(" ")),
            ("city", _at("address.city")),
            ("state", _at("address.state")),
            ("zip", _at("address.postalCode")),
            ("country", _at("address.country")),
            ("lat", _at("position.latitude"), "decimal"),
            ("lng", _at("position.longitude"), "decimal"),
        ),
    ),
)

medication_administration = View(
    "MedicationAdministration__drug_exposure",
    "MedicationAdministration",
    (
        _cols(
            _ID,
            _SUBJECT,
            _CONTEXT,
            ("code_rxnorm", _code(_DRUG, RXNORM), "code"),
            ("code_ndc", _code(_DRUG, NDC), "code"),
            ("code_snomed", _code(_DRUG, SNOMED), "code"),
            _DRUG_TEXT,
            _EFFECTIVE,
            ("status_code", _at("status"), "code"),
        ),
    ),
)

medication_dispense = View(
    "MedicationDispense__drug_exposure",
    "MedicationDispense",
    (
        _cols(
            _ID,
            _SUBJECT,
            _CONTEXT,
            *_DRUG_CODES,
            ("dispense_dt", _at("whenHandedOver"), "dateTime"),
            ("quantity_value", _at("quantity.value"), "decimal"),
            ("days_supply", _at("daysSupply.value"), "integer"),
        ),
    ),
)

medication_request = View(
    "MedicationRequest__drug_exposure",
    "MedicationRequest",
    (
        _cols(
            _ID,
            _STATUS,
            _SUBJECT,
            _ENCOUNTER,
            ("requester_ref", _ref("requester")),
            ("code_rxnorm", _code(_DRUG, RXNORM), "code"),
            ("code_ndc", _code(_DRUG, NDC), "code"),
            _DRUG_TEXT,
            ("authored_on", _at("authoredOn"), "dateTime"),
            ("status_code", _at("status"), "code"),
        ),
    ),
)

medication_statement = View(
    "MedicationStatement__drug_exposure",
    "MedicationStatement",
    (
        _cols(
            _ID,
            _SUBJECT,
            _CONTEXT,
            *_DRUG_CODES,
            _EFFECTIVE,
            ("period_start", _as("effective", "Period", "start"), "dateTime"),
            ("period_end", _as("effective", "Period", "end"), "dateTime"),
            ("status_code", _at("status"), "code"),
        ),
    ),
)

medication = View(
    "Medication__drug_exposure",
    "Medication",
    (
        _cols(
            _ID,
            ("drug_rxnorm", _code("code", RXNORM), "code"),
            ("drug_ndc", _code("code", NDC), "code"),
            _TEXT,
        ),
    ),
)

observation = View(
    "Observation__measurement",
    "Observation",
    (
        _cols(
            *_OBSERVATION_HEAD,
            _TEXT,
            _EFFECTIVE,
            _EFFECTIVE_START,
            ("value_number", _at("valueQuantity.value"), "decimal"),
            ("value_string", _at("valueString")),
            ("value_comparator", _at("valueQuantity.comparator"), "code"),
            ("value_unit_code", _at("valueQuantity.code"), "code"),
            ("value_unit_text", _at("valueQuantity.unit")),
            ("value_code_system", _coding("valueCodeableConcept", "system"), "uri"),
            ("value_code", _coding("valueCodeableConcept"), "code"),
            ("value_text", _at("valueCodeableConcept.text")),
            ("qualifier_code", _first_coding("interpretation"), "code"),
            ("range_low", lambda n: n.get("referenceRange").first().get("low.value"), "decimal"),
            ("range_high", lambda n: n.get("referenceRange").first().get("high.value"), "decimal"),
        ),
        ForEach(_at("code.coding"), (_EACH_CODING,)),
    ),
)

observation_component = View(
    "Observation_component__measurement",
    "Observation",
    (
        _cols(*_OBSERVATION_HEAD, _EFFECTIVE, _EFFECTIVE_START),
        ForEach(
            _at("component"),
            (
                _cols(
                    ("component_code_system", _coding("code", "system"), "uri"),
                    ("component_code", _coding("code"), "code"),
                    ("component_code_text", _at("code.text")),
                    ("component_value_num", _at("valueQuantity.value"), "decimal"),
                    ("component_unit_code", _at("valueQuantity.code"), "code"),
                    ("component_unit_text", _at("valueQuantity.unit")),
                    ("component_value_code_system", _coding("valueCodeableConcept", "system"), "uri"),
                    ("component_value_code", _coding("valueCodeableConcept"), "code"),
                    ("component_value_text", _at("valueCodeableConcept.text")),
                    ("component_value_string", _at("valueString")),
                ),
            ),
        ),
    ),
)

organization = View(
    "Organization__care_site",
    "Organization",
    (_cols(_ID, ("name", _at("name")), ("type_code", _first_coding("type"), "code")),),
)

patient_death = View(
    "Patient__death",
    "Patient",
    (_cols(_ID, ("death_dt", _as("deceased", "dateTime"), "dateTime")),),
)


def _geo(part: str) -> Path:
    return lambda n: n.extension(GEOLOCATION).extension(part).get("valueDecimal").first()


patient_location = View(
    "Patient__location",
    "Patient",
    (
        _cols(
            _ID,
            ("address_1", lambda n: n.get("address.line").at(0)),
            ("address_2", lambda n: n.get("address.line").at(1)),
            ("city", _at("address.city")),
            ("state", _at("address.state")),
            ("zip", _at("address.postalCode")),
            ("county", _at("address.district")),
            ("country_text", _at("address.country")),
            (
                "latitude",
                lambda n: n.get("address").extension(GEOLOCATION).extension("latitude").get("valueDecimal"),
                "decimal",
            ),
            (
                "longitude",
                lambda n: n.get("address").extension(GEOLOCATION).extension("longitude").get("valueDecimal"),
                "decimal",
            ),
        ),
    ),
)

patient_observation_period = View("Patient__observation_period", "Patient", (_cols(_ID),))


def _main_address(n: Node) -> Node:
    address = n.get("address")
    return address.where("use", "official").union(address).first()


patient = View(
    "Patient__person",
    "Patient",
    (
        _cols(
            _ID,
            ("gender", _at("gender"), "code"),
            ("us_core_birthsex", lambda n: n.extension(US_CORE_BIRTHSEX).get("valueCode").first(), "code"),
            ("birth_date", _at("birthDate"), "date"),
            (
                "birth_time",
                lambda n: n.get("_birthDate").extension(BIRTH_TIME).get("valueDateTime").first(),
                "dateTime",
            ),
            ("omop_race_code", lambda n: n.extension_named(OMOP_RACE_NAME).get("valueCoding.code").first(), "code"),
            ("omop_race_display", lambda n: n.extension_named(OMOP_RACE_NAME).get("valueCoding.display").first()),
            (
                "race_omb_code",
                lambda n: n.extension(US_CORE_RACE).extension("ombCategory").get("valueCoding.code").first(),
                "code",
            ),
            ("race_text", lambda n: n.extension(US_CORE_RACE).extension("text").get("valueString").first()),
            (
                "omop_ethnicity_code",
                lambda n: n.extension_named(OMOP_ETHNICITY_NAME).get("valueCoding.code").first(),
                "code",
            ),
            (
                "omop_ethnicity_display",
                lambda n: n.extension_named(OMOP_ETHNICITY_NAME).get("valueCoding.display").first(),
            ),
            (
                "ethnicity_omb_code",
                lambda n: n.extension(US_CORE_ETHNICITY).extension("ombCategory").get("valueCoding.code").first(),
                "code",
            ),
            ("ethnicity_text", lambda n: n.extension(US_CORE_ETHNICITY).extension("text").get("valueString").first()),
            ("general_practitioner_ref", _first_ref("generalPractitioner")),
            ("managing_organization_ref", _ref("managingOrganization")),
        ),
        ForEach(
            _main_address,
            (
                _cols(
                    ("location_line", lambda n: n.get("line").join(" ")),
                    ("location_city", _at("city")),
                    ("location_state", _at("state")),
                    ("location_zip", _at("postalCode")),
                    ("location_county", _at("district")),
                    ("location_country", _at("country")),
                    ("location_lat", _geo("latitude"), "decimal"),
                    ("location_lng", _geo("longitude"), "decimal"),
                ),
            ),
            or_null=True,
        ),
    ),
)

practitioner_role = View(
    "PractitionerRole__provider",
    "PractitionerRole",
    (
        _cols(
            ("practitioner_ref", _ref("practitioner")),
            ("org_ref", _ref("organization")),
            ("specialty_code", lambda n: n.get("specialty").first().lookup(SNOMED), "code"),
        ),
    ),
)

practitioner = View(
    "Practitioner__provider",
    "Practitioner",
    (
        _cols(
            _ID,
            ("npi", lambda n: n.get("identifier").where("system", US_NPI).get("value").first()),
            ("family", lambda n: n.get("name").first().get("family")),
            ("given", lambda n: n.get("name").first().get("given").first()),
            ("gender", _at("gender"), "code"),
        ),
    ),
)

procedure = View(
    "Procedure__procedure_occurrence",
    "Procedure",
    (
        _cols(
            _ID,
            _STATUS,
            _SUBJECT,
            _ENCOUNTER,
            ("code_snomed", _code("code", SNOMED), "code"),
            ("code_cpt4", _code("code", CPT4), "code"),
            ("code_hcpcs", _code("code", HCPCS), "code"),
            ("code_icd10pcs", _code("code", ICD10PCS), "code"),
            _TEXT,
            ("performed_dt", _as("performed", "dateTime"), "dateTime"),
            ("performed_period_start", _as("performed", "Period", "start"), "dateTime"),
            ("performed_period_end", _as("performed", "Period", "end"), "dateTime"),
            ("performer_ref", lambda n: n.get("performer").first().get("actor").reference_key()),
            ("status_code", _at("status"), "code"),
        ),
    ),
)

specimen = View(
    "Specimen__specimen",
    "Specimen",
    (
        _cols(
            _ID,
            _SUBJECT,
            ("type_snomed", _code("type", SNOMED), "code"),
            ("body_site_snomed", _code("collection.bodySite", SNOMED), "code"),
            ("collected_dt", _at("collection.collectedDateTime"), "dateTime"),
            ("quantity_value", _at("collection.quantity.value"), "decimal"),
        ),
    ),
)

ALL_VIEWS: dict[str, View] = {v.name: v for v in list(globals().values()) if isinstance(v, View)}
