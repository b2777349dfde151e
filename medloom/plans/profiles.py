"""Elements that a resource must have to enter an edge when the strict gate is on."""

from __future__ import annotations

# Required elements per edge; 'onset[x]' stands for any element that starts with 'onset'.
REQUIRED_ELEMENTS: dict[str, list[str]] = {
    "AllergyIntolerance__observation": ["code", "patient"],
    "Condition__condition_occurrence": ["code", "subject", "onset[x]"],
    "Coverage__payer_plan_period": ["status", "beneficiary", "period", "period.start", "payor"],
    "Device__device_exposure": ["type", "patient"],
    "DiagnosticReport__measurement": ["code", "subject", "effective[x]"],
    "DiagnosticReport__note": ["code", "subject", "effective[x]"],
    "DiagnosticReport__observation": ["code", "subject", "effective[x]"],
    "DiagnosticReport__procedure_occurrence": ["code", "subject", "effective[x]"],
    "Encounter__visit_occurrence": ["status", "class", "subject", "period", "period.start"],
    "Immunization__drug_exposure": ["status", "vaccineCode", "patient", "occurrence[x]"],
    "Location__care_site": ["identifier", "physicalType", "managingOrganization"],
    "Location__location": ["name", "address"],
    "MedicationAdministration__drug_exposure": ["status", "medication[x]", "subject", "effective[x]"],
    "MedicationDispense__drug_exposure": ["status", "medication[x]", "subject", "whenHandedOver"],
    "MedicationRequest__drug_exposure": ["status", "intent", "medication[x]", "subject", "authoredOn"],
    "MedicationStatement__drug_exposure": ["status", "medication[x]", "subject", "effective[x]"],
    "Medication__drug_exposure": ["code"],
    "Observation__measurement": ["code", "subject", "effective[x]", "value[x]"],
    "Observation__observation": ["code", "subject", "effective[x]"],
    "Organization__care_site": ["identifier", "name"],
    "Patient__death": ["deceased[x]"],
    "Patient__location": ["address"],
    "Patient__observation_period": ["id"],
    "Patient__person": ["gender", "birthDate"],
    "PractitionerRole__provider": ["practitioner", "specialty", "specialty.coding"],
    "Practitioner__provider": ["identifier", "name"],
    "Procedure__procedure_occurrence": ["code", "subject", "performed[x]"],
    "Specimen__specimen": ["type", "subject"],
}
