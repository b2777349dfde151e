"""Typed subset of the FHIR R4 resources: the elements that the views read, nothing else."""

from __future__ import annotations

from pyspark.sql import types as T

_CODING = "struct<system:string,code:string,display:string>"
_CONCEPT = f"struct<coding:array<{_CODING}>,text:string>"
_REF = "struct<reference:string,display:string>"
_PERIOD = "struct<start:string,end:string>"
_QUANTITY = "struct<value:decimal(38,10),comparator:string,unit:string,system:string,code:string>"
_IDENT = "array<struct<system:string,value:string>>"
_EXT_VALUE = (
    f"url:string,valueString:string,valueCode:string,valueCoding:{_CODING},"
    "valueDateTime:string,valueDecimal:decimal(38,10)"
)
_EXT = f"array<struct<{_EXT_VALUE},extension:array<struct<{_EXT_VALUE}>>>>"
_ADDRESS = (
    "use:string,line:array<string>,city:string,state:string,postalCode:string,district:string,country:string"
)
_MEDICATION = f"id:string,status:string,medicationCodeableConcept:{_CONCEPT},subject:{_REF}"

_FIELDS: dict[str, str] = {
    "Patient": f"id:string,gender:string,birthDate:string,_birthDate:struct<extension:{_EXT}>,"
    f"deceasedDateTime:string,deceasedBoolean:boolean,extension:{_EXT},"
    f"address:array<struct<{_ADDRESS},extension:{_EXT}>>,"
    f"generalPractitioner:array<{_REF}>,managingOrganization:{_REF}",
    "Practitioner": f"id:string,identifier:{_IDENT},name:array<struct<family:string,given:array<string>>>,"
    "gender:string",
    "PractitionerRole": f"id:string,practitioner:{_REF},organization:{_REF},specialty:array<{_CONCEPT}>",
    "Organization": f"id:string,identifier:{_IDENT},name:string,type:array<{_CONCEPT}>",
    "Location": f"id:string,identifier:{_IDENT},name:string,type:array<{_CONCEPT}>,address:struct<{_ADDRESS}>,"
    "position:struct<latitude:decimal(38,10),longitude:decimal(38,10)>",
    "Encounter": f"id:string,status:string,class:{_CODING},type:array<{_CONCEPT}>,subject:{_REF},"
    f"period:{_PERIOD},serviceProvider:{_REF},participant:array<struct<individual:{_REF}>>,partOf:{_REF},"
    f"hospitalization:struct<admitSource:{_CONCEPT},dischargeDisposition:{_CONCEPT}>",
    "Condition": f"id:string,clinicalStatus:{_CONCEPT},verificationStatus:{_CONCEPT},category:array<{_CONCEPT}>,"
    f"code:{_CONCEPT},evidence:array<struct<concept:{_CONCEPT}>>,subject:{_REF},encounter:{_REF},"
    f"recorder:{_REF},asserter:{_REF},onsetDateTime:string,onsetPeriod:{_PERIOD},recordedDate:string,"
    f"abatementDateTime:string,abatementPeriod:{_PERIOD},abatementString:string",
    "Observation": f"id:string,status:string,code:{_CONCEPT},subject:{_REF},encounter:{_REF},"
    f"performer:array<{_REF}>,effectiveDateTime:string,effectivePeriod:{_PERIOD},valueQuantity:{_QUANTITY},"
    f"valueString:string,valueCodeableConcept:{_CONCEPT},interpretation:array<{_CONCEPT}>,"
    f"referenceRange:array<struct<low:{_QUANTITY},high:{_QUANTITY}>>,"
    f"component:array<struct<code:{_CONCEPT},valueQuantity:{_QUANTITY},valueCodeableConcept:{_CONCEPT},"
    "valueString:string>>",
    "DiagnosticReport": f"id:string,status:string,code:{_CONCEPT},subject:{_REF},encounter:{_REF},"
    f"performer:array<{_REF}>,effectiveDateTime:string,presentedForm:array<struct<data:string>>,"
    "conclusion:string",
    "Procedure": f"id:string,status:string,code:{_CONCEPT},subject:{_REF},encounter:{_REF},"
    f"performedDateTime:string,performedPeriod:{_PERIOD},performer:array<struct<actor:{_REF}>>",
    "MedicationRequest": f"{_MEDICATION},encounter:{_REF},requester:{_REF},authoredOn:string",
    "MedicationAdministration": f"{_MEDICATION},context:{_REF},effectiveDateTime:string",
    "MedicationDispense": f"{_MEDICATION},context:{_REF},whenHandedOver:string,quantity:{_QUANTITY},"
    f"daysSupply:{_QUANTITY}",
    "MedicationStatement": f"{_MEDICATION},context:{_REF},effectiveDateTime:string,effectivePeriod:{_PERIOD}",
    "Medication": f"id:string,code:{_CONCEPT}",
    "Immunization": f"id:string,status:string,vaccineCode:{_CONCEPT},patient:{_REF},encounter:{_REF},"
    "occurrenceDateTime:string",
    "AllergyIntolerance": f"id:string,clinicalStatus:{_CONCEPT},verificationStatus:{_CONCEPT},code:{_CONCEPT},"
    f"patient:{_REF},encounter:{_REF},recordedDate:string,onsetDateTime:string",
    "Device": f"id:string,status:string,type:{_CONCEPT},patient:{_REF},"
    "udiCarrier:array<struct<deviceIdentifier:string>>,lotNumber:string,manufactureDate:string,"
    "expirationDate:string",
    "Specimen": f"id:string,type:{_CONCEPT},subject:{_REF},"
    f"collection:struct<collectedDateTime:string,bodySite:{_CONCEPT},quantity:{_QUANTITY}>",
    "Coverage": f"id:string,beneficiary:{_REF},period:{_PERIOD},payor:array<{_REF}>,type:{_CONCEPT}",
}

RESOURCE_TYPES = tuple(_FIELDS)


def ddl(resource_type: str) -> str:
    return f"struct<{_FIELDS[resource_type]}>"


def schema(resource_type: str) -> T.StructType:
    return T.DataType.fromDDL(ddl(resource_type))
