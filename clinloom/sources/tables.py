"""Table definitions: columns, declared lengths, required columns, keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A table as declared; storage keeps texts unbounded, lengths are a check."""

    ddl: str
    # Surrogate key column and its first value.
    identity: tuple[str, int] | None = None
    # Column of ascending ids that the rows bring themselves.
    numbers: str | None = None
    # Column filled with the load time where a row brings none.
    stamp: str | None = None
    unique: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    # False where the rows are as wide as documents: files follow the scan's
    # partitions and no text crosses the network for the sake of file sizes.
    rebalance: bool = True
    # True where the rows are made of another table: they are replaced by day, and no commit holds them.
    derived: bool = False

    @cached_property
    def declared(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @cached_property
    def schema(self) -> T.StructType:
        """Storage schema: plain strings, everything nullable."""
        plain = (T.VarcharType, T.CharType)
        return T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, plain) else f.dataType)
            for f in self.declared
        ])

    @cached_property
    def lengths(self) -> dict[str, int]:
        return {
            f.name: f.dataType.length
            for f in self.declared
            if isinstance(f.dataType, (T.VarcharType, T.CharType))
        }

    @cached_property
    def required(self) -> list[str]:
        """NOT NULL columns that a row has to bring itself."""
        own = {self.stamp, self.identity[0] if self.identity else None}
        return [f.name for f in self.declared if not f.nullable and f.name not in own]


# Names, types, lengths and seeds of the tables.
_CLAIM_COLUMNS = """
    claimId VARCHAR(100) NOT NULL, claimStatus VARCHAR(20), claimUse VARCHAR(50),
    claimPatientId VARCHAR(100) NOT NULL, claimbillablePeriodStart TIMESTAMP_NTZ NOT NULL,
    claimbillablePeriodEnd TIMESTAMP_NTZ NOT NULL, claimCreated TIMESTAMP_NTZ,
    claimProviderReference VARCHAR(500), claimPriorityCode VARCHAR(50),
    claimPrescriptionId VARCHAR(100), claimFocal BOOLEAN, insuranceSequence INT,
    claimCoverage VARCHAR(100), itemSequence INT, claimCode VARCHAR(100), encounterId VARCHAR(100),
    claimTotal DECIMAL(19,4), claimCurrency VARCHAR(10)"""

TABLES = {
    "fact_claim": Table(
        f"Id BIGINT NOT NULL, {_CLAIM_COLUMNS}, created_dt TIMESTAMP_NTZ NOT NULL",
        identity=("Id", 10), stamp="created_dt",
    ),
    "fact_encounters": Table(
        """ID BIGINT NOT NULL, encounter_ID VARCHAR(100) NOT NULL, `start` TIMESTAMP_NTZ,
        `end` TIMESTAMP_NTZ, patientID VARCHAR(100), organizationID VARCHAR(100),
        practitionerID VARCHAR(100), encounter_class VARCHAR(100), encounter_code VARCHAR(100),
        encounter_description VARCHAR(100), encounterReasonName VARCHAR(500),
        encounterReasonCode VARCHAR(500), CREATE_DT TIMESTAMP_NTZ""",
        identity=("ID", 1), stamp="CREATE_DT",
    ),
    "fact_encounter_conditions": Table(
        """patientID VARCHAR(100) NOT NULL, encounter_ID VARCHAR(100) NOT NULL,
        condition_code VARCHAR(50) NOT NULL, `start` DATE, `end` DATE, created_dt TIMESTAMP_NTZ""",
        stamp="created_dt", unique=("patientID", "encounter_ID", "condition_code"),
    ),
    "fact_medication_request": Table(
        """ID BIGINT NOT NULL, medicationRequestID VARCHAR(100), medicationRequestStatus VARCHAR(100),
        medicationRequestIntent VARCHAR(100), medicationName VARCHAR(500), medicationCode VARCHAR(100),
        medicationCategoryAdministration VARCHAR(200), patientId VARCHAR(100), encounterID VARCHAR(100),
        medicationRequestCreated TIMESTAMP_NTZ, doctorID VARCHAR(100),
        medicationRequestReasonID VARCHAR(100), conditionThatCausedMedicationRequest VARCHAR(100),
        asNeededBoolean BOOLEAN, sequence INT, frequency INT, period DOUBLE, periodUnit CHAR(10),
        dosageQuantity DOUBLE, created_dt TIMESTAMP_NTZ""",
        identity=("ID", 100), stamp="created_dt",
    ),
    "fact_Identification": Table(
        """Id BIGINT NOT NULL, personNumber VARCHAR(50) NOT NULL, idNumber VARCHAR(50),
        idTypeName VARCHAR(50), idShortCode VARCHAR(50)""",
        identity=("Id", 10),
    ),
    # Holds what the extractor gives: the declared columns are those of a claim
    # and nothing ever filled them.
    "fact_EplanationOfBenefit": Table(
        """Id BIGINT NOT NULL, ExplanationOfBenefitId STRING NOT NULL, status STRING,
        ExplanationOfBenefitUse STRING, ExplanationOfBenefitCodingDetailsCode STRING, patientID STRING,
        billablePeriodStart STRING, billablePeriodEnd STRING, created STRING, providerReference STRING,
        coverage STRING, itemSequence INT, itemProductOrderServiceCode STRING,
        containedResourceType STRING, containedId STRING, containedStatus STRING,
        containedIntent STRING, containedSubject STRING, containedReference STRING,
        containedPerformer STRING, containedType STRING, containedBeneficiary STRING,
        containedPayor STRING, itemEncounterId STRING, outcome STRING, roleCode STRING,
        careTeamRoleName STRING, careTeamSequence STRING, careTeamProvider STRING,
        itemcategoryCode STRING, itemcategoryName STRING, servicePeriodStart STRING,
        servicePeriodEnd STRING, locationCodeableConceptCode STRING,
        locationCodeableConceptName STRING, ExplanationOfBenefitCurrency STRING,
        ExplanationOfBenefitTotalAmount STRING, totalCategoryCode STRING, totalCategoryName STRING,
        paymentAmountValue DECIMAL(19,4), paymentAmountCurrency STRING""",
        identity=("Id", 10),
    ),
    "dim_patient": Table(
        """ID VARCHAR(100) NOT NULL, DOB DATE NOT NULL, DOD DATE, SSN VARCHAR(10), prefix VARCHAR(10),
        firstname VARCHAR(50) NOT NULL, lastname VARCHAR(50) NOT NULL, suffix VARCHAR(10),
        maiden VARCHAR(50), marital VARCHAR(5), race VARCHAR(15), ethnicity VARCHAR(50),
        gender VARCHAR(5), address VARCHAR(50), city VARCHAR(50), state VARCHAR(50), zip VARCHAR(50),
        created_dt TIMESTAMP_NTZ""",
        stamp="created_dt", unique=("ID",),
    ),
    "dim_practitioner": Table(
        """ID VARCHAR(100) NOT NULL, prefix VARCHAR(10), firstname VARCHAR(50), lastname VARCHAR(50),
        gender VARCHAR(20), address VARCHAR(100), city VARCHAR(50), state VARCHAR(50), zip VARCHAR(50),
        contactvalue VARCHAR(100), contacttype VARCHAR(100), contactmethod VARCHAR(100),
        created_dt TIMESTAMP_NTZ NOT NULL""",
        stamp="created_dt", unique=("ID",),
    ),
    "dim_organization": Table(
        """ID VARCHAR(100) NOT NULL, name VARCHAR(500), address VARCHAR(200), city VARCHAR(200),
        state VARCHAR(200), zip VARCHAR(100), lat DOUBLE, lon DOUBLE, phone VARCHAR(100),
        revenue DOUBLE, utilization INT, type STRING, created_dt TIMESTAMP_NTZ""",
        stamp="created_dt", unique=("ID",),
    ),
    "dim_payer": Table(
        """ID VARCHAR(100) NOT NULL, name VARCHAR(100), address VARCHAR(300), city VARCHAR(100),
        state VARCHAR(100), zip VARCHAR(100), phone VARCHAR(100), created_dt TIMESTAMP_NTZ NOT NULL""",
        stamp="created_dt", unique=("ID",),
    ),
    "dim_condition": Table(
        """ID BIGINT NOT NULL, code VARCHAR(100) NOT NULL, description VARCHAR(250), START DATE,
        END DATE, patient VARCHAR(250), encounter VARCHAR(100), system VARCHAR(100),
        created_dt TIMESTAMP_NTZ""",
        identity=("ID", 1), stamp="created_dt",
    ),
    # Every imported file: status 1 is a JSON document, 2 was rejected and is
    # kept apart in its own partition.
    "JSONLogs": Table(
        """doc_id BIGINT NOT NULL, json STRING, file_path STRING, file_name VARCHAR(150),
        import_ts TIMESTAMP_NTZ, checksum STRING, batch STRING, status INT, import_date DATE""",
        partition_by=("status", "import_date"), rebalance=False, numbers="doc_id",
    ),
    # The documents' entries, parsed once; each extractor reads its own partition.
    "bundle_entries": Table(
        """doc_id BIGINT, file_path STRING, fullUrl STRING, resource VARIANT, import_date DATE,
        resourceType STRING""",
        partition_by=("import_date", "resourceType"), derived=True,
    ),
    # Forerunner of the document log: texts only.
    "JSONDOCUMENTS": Table("ID BIGINT NOT NULL, JSONDOCUMENT STRING NOT NULL", identity=("ID", 10)),
    "JSONImportLog": Table(
        "ID BIGINT NOT NULL, JSONLogsId BIGINT NOT NULL, ResourceType VARCHAR(50), ExportDate TIMESTAMP_NTZ",
        identity=("ID", 100), unique=("JSONLogsId",),
    ),
    "import_error_logs": Table(
        """_ID BIGINT NOT NULL, FILENAME VARCHAR(250), ERRORNUMBER INT, ERRORLINE INT,
        ERRORMESSAGE STRING, IMPORTDATETIME TIMESTAMP_NTZ""",
        identity=("_ID", 1),
    ),
}
