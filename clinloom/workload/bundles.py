"""Bundle documents that Spark builds from the given tables.

Every table row becomes one document of its own (no rows are collected into a
document), with as many array elements as its values say. The comparison SQL
computes the extractor's result from the tables directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators.shred import explode_entries
from clinloom.workload.registry import Tables

# --- SQL text of JSON parts ---------------------------------------------------


def st(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def arr(*values: str) -> str:
    return "array(" + ", ".join(values) + ")"


def first_n(n: str, *values: str) -> str:
    """The first n of the values, n being an SQL expression."""
    return f"slice({arr(*values)}, 1, {n})"


def urn(key: str) -> str:
    return f"concat('urn:uuid:', {key})"


def ref(key: str) -> str:
    return st(reference=urn(key))


def piped(kind: str, key: str) -> str:
    return st(reference=f"concat('{kind}?identifier=sys|', {key})")


def coded(*codings: tuple[str, str]) -> str:
    return st(coding=arr(*[st(code=c, display=d) for c, d in codings]))


def late(day: str) -> str:
    """Late evening, five hours behind: the next day when read as an instant."""
    return f"concat(CAST(CAST({day} AS DATE) AS STRING), 'T23:30:00-05:00')"


def early(day: str) -> str:
    return f"concat(CAST(CAST({day} AS DATE) AS STRING), 'T00:30:00+09:00')"


_OTHER = '{"fullUrl":"urn:uuid:other","resource":{"resourceType":"Observation","status":"final"}}'


def entry(url: str, kind: str, **fields: str) -> str:
    resource = st(resourceType=f"'{kind}'", **fields)
    return f"to_json({st(fullUrl=urn(url), resource=resource)})"


def documents(rows: DataFrame, doc_id: str, *entries: str) -> DataFrame:
    """One bundle per row: the entries, and one entry of a type nobody reads."""
    body = ", ',', ".join([*entries, f"'{_OTHER}'"])
    head = '{"resourceType":"Bundle","type":"transaction","entry":['
    return rows.hint("rebalance").selectExpr(f"{doc_id} AS doc_id", f"concat('{head}', {body}, ']}}') AS json")


def entries(rows: DataFrame, doc_id: str, kind: str, url: str, **fields: str) -> DataFrame:
    return explode_entries(documents(rows, doc_id, entry(url, kind, **fields)), kind)


# --- base rows ------------------------------------------------------------------


def order_lines(t: Tables) -> DataFrame:
    """Orders with their lines; an order without lines is one row."""
    lines = t.lineitem.drop("l_discount", "l_tax")
    return t.orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left")


def line_parts(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_name", "p_type", "p_brand")
    return t.lineitem.join(parts, F.expr("l_partkey = p_partkey"))


# --- resources -------------------------------------------------------------------


def claims(t: Tables) -> DataFrame:
    return entries(
        order_lines(t), "o_orderkey", "Claim", "o_orderkey",
        status="o_orderstatus",
        use="'claim'",
        type=coded(("l_returnflag", "'type'")),
        patient=ref("o_custkey"),
        billablePeriod=st(start=late("o_orderdate"), end=early("l_shipdate")),
        created=early("o_orderdate"),
        provider=ref("l_suppkey"),
        priority=coded(("o_orderpriority", "'priority'")),
        prescription=f"CASE WHEN l_linestatus = 'F' THEN {ref('l_partkey')} END",
        insurance=first_n(
            "CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END",
            st(sequence="1", focal="true", coverage=st(display="concat('Plan ', o_custkey)")),
            st(sequence="2", focal="false", coverage=st(display="'Other'")),
        ),
        item=first_n(
            "CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END",
            st(
                sequence="l_linenumber",
                productOrService=coded(("CAST(l_partkey AS STRING)", "'a'"), ("CAST(l_suppkey AS STRING)", "'b'")),
                encounter=arr(ref("l_orderkey")),
            ),
        ),
        total=st(value="l_extendedprice", currency="'USD'"),
    )


def mixed(t: Tables) -> DataFrame:
    """Entries of bundles with three wanted types each, the claim with one to three items."""
    item = st(sequence="i", productOrService=coded(("'c'", "'d'")), encounter=arr(ref("l_orderkey")))
    return explode_entries(documents(
        t.lineitem, "l_orderkey * 10 + l_linenumber",
        entry(
            "concat(l_orderkey, '-', l_linenumber)", "Claim", status="l_linestatus", patient=ref("l_suppkey"),
            item=f"transform(sequence(1, l_linenumber % 3 + 1), i -> {item})",
            total=st(value="l_extendedprice", currency="'USD'"),
        ),
        entry("l_orderkey", "Encounter", **{"class": st(code="l_returnflag")}, subject=ref("l_suppkey")),
        entry("l_partkey", "Patient", gender="l_linestatus"),
    ))


def encounters(t: Tables) -> DataFrame:
    return entries(
        t.orders, "o_orderkey", "Encounter", "o_orderkey",
        **{"class": st(code="o_orderpriority")},
        type=arr(st(text="'t'", coding=arr(
            st(code="o_orderstatus", display="'status'"), st(code="o_orderpriority", display="'priority'")
        ))),
        subject=ref("o_custkey"),
        period=st(start=late("o_orderdate"), end=early("o_orderdate")),
        participant=first_n(
            "CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END",
            st(individual=piped("Practitioner", "o_custkey % 100")),
            st(individual=ref("o_custkey % 7")),
        ),
        reasonCode=first_n(
            "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END",
            coded(("CAST(o_custkey AS STRING)", "'reason'")),
        ),
        serviceProvider=piped("Organization", "o_custkey % 25"),
    )


def medication_requests(t: Tables, dose_in_instruction: bool = False) -> DataFrame:
    def dosage(sequence: str) -> str:
        dose = {"doseAndRate": arr(st(doseQuantity=st(value=f"l_quantity + {sequence}")))} if dose_in_instruction else {}
        return st(
            sequence=sequence,
            asNeededBoolean="l_returnflag = 'R'",
            timing=st(repeat=st(frequency="l_linenumber", period="l_tax", periodUnit="'d'")),
            **dose,
        )

    return entries(
        line_parts(t), "l_orderkey", "MedicationRequest", "l_orderkey",
        status="l_linestatus",
        intent="'order'",
        medicationCodeableConcept=st(
            coding=arr(st(code="CAST(p_partkey AS STRING)", display="p_name")), text="p_brand"
        ),
        subject=ref("l_suppkey"),
        encounter=ref("l_orderkey"),
        authoredOn=late("l_shipdate"),
        requester=piped("Practitioner", "l_suppkey"),
        reasonReference=arr(st(reference=urn("l_partkey"), display="p_type")),
        dosageInstruction=first_n("CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END", dosage("1"), dosage("2")),
        doseAndRate=arr(st(doseQuantity=st(value="l_quantity"))),
    )


def benefits(t: Tables) -> DataFrame:
    two = "CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END"
    return entries(
        t.orders, "o_orderkey", "ExplanationOfBenefit", "o_orderkey",
        status="'active'",
        use="'claim'",
        type=coded(("o_orderstatus", "'type'")),
        patient=ref("o_custkey"),
        billablePeriod=st(start=late("o_orderdate"), end=early("o_orderdate")),
        created=early("o_orderdate"),
        provider=ref("o_custkey % 25"),
        outcome="'complete'",
        insurance=arr(st(coverage=st(display="concat('Plan ', o_custkey % 5)"))),
        contained=first_n(
            "2",
            st(
                resourceType="'ServiceRequest'", id="'referral'", status="'completed'", intent="'order'",
                subject=ref("o_custkey"), requester=ref("o_custkey % 100"), performer=arr(ref("o_custkey % 7")),
                type=st(text="CAST(NULL AS STRING)"), beneficiary=st(reference="CAST(NULL AS STRING)"),
                payor=arr(st(display="CAST(NULL AS STRING)")),
            ),
            st(
                resourceType="'Coverage'", id="'coverage'", status="'active'", intent="CAST(NULL AS STRING)",
                subject=st(reference="CAST(NULL AS STRING)"), requester=st(reference="CAST(NULL AS STRING)"),
                performer=arr(st(reference="CAST(NULL AS STRING)")),
                type=st(text="o_orderpriority"), beneficiary=ref("o_custkey"),
                payor=arr(st(display="'Payer'")),
            ),
        ),
        careTeam=first_n(
            two,
            st(sequence="1", provider=ref("o_custkey % 100"), role=coded(("'primary'", "'Primary provider'"))),
            st(sequence="2", provider=ref("o_custkey % 7"), role=coded(("'other'", "'Other provider'"))),
        ),
        item=arr(st(
            sequence="1", category=coded(("'1'", "'Medical care'")),
            productOrService=coded(("o_orderpriority", "'p'")),
            encounter=arr(ref("o_orderkey")),
            servicedPeriod=st(start=late("o_orderdate"), end=early("o_orderdate")),
            locationCodeableConcept=coded(("'21'", "'Inpatient Hospital'")),
        )),
        total=first_n(
            two,
            st(category=coded(("'submitted'", "'Submitted Amount'")), amount=st(value="o_totalprice", currency="'USD'")),
            st(category=coded(("'benefit'", "'Benefit Amount'")), amount=st(value="o_custkey", currency="'USD'")),
        ),
        payment=st(amount=st(value="o_totalprice", currency="'USD'")),
    )


def care_teams(t: Tables) -> DataFrame:
    def role(code: str) -> str:
        return st(coding=arr(st(system="'snomed'", code=code, display="c_mktsegment")))

    return entries(
        t.customer, "c_custkey", "CareTeam", "c_custkey",
        id="CAST(c_custkey AS STRING)",
        status="'active'",
        subject=ref("c_custkey"),
        encounter=ref("c_nationkey"),
        period=st(start="'2020-01-01'"),
        participant=first_n(
            "CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END",
            st(role=arr(role("'r1'"), role("'r2'")), member=st(reference=urn("c_custkey"), display="c_name")),
            st(role=arr(role("'r3'")), member=st(reference=urn("c_nationkey"), display="'doctor'")),
        ),
        reasonCode=arr(st(coding=arr(st(system="'snomed'", code="'x'", display="c_mktsegment")))),
        managingOrganization=arr(st(reference=urn("c_nationkey"), display="'HOSPITAL'")),
    )


def care_plans(t: Tables) -> DataFrame:
    return entries(
        order_lines(t), "o_orderkey", "CarePlan", "o_orderkey",
        id="CAST(o_orderkey AS STRING)",
        status="o_orderstatus",
        intent="'order'",
        subject=ref("o_custkey"),
        encounter=ref("o_orderkey"),
        period=st(start="CAST(CAST(o_orderdate AS DATE) AS STRING)"),
        category=arr(st(coding=arr(st(system="'snomed'", code="o_orderpriority", display="'priority'")))),
        careTeam=arr(ref("o_custkey"), ref("o_orderkey")),
        activity=first_n(
            "CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END",
            st(detail=st(
                status="l_linestatus", location=st(display="l_returnflag"),
                code=st(text="'activity'", coding=first_n(
                    "CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END",
                    st(system="'s1'", code="CAST(l_partkey AS STRING)", display="'part'"),
                    st(system="'s2'", code="CAST(l_suppkey AS STRING)", display="'supplier'"),
                )),
            )),
        ),
    )


def _name(family: str, given: str) -> str:
    return arr(st(family=family, given=arr(given, "'Middle'"), prefix=arr("'Dr.'")))


def _home(city: str) -> str:
    return arr(st(line=arr("'1 Elm St'"), city=city, state="'MA'", postalCode="'01970'", country="'US'"))


def _phones(n: str, value: str) -> str:
    return first_n(
        n,
        st(system="'phone'", value=value, use="'home'"),
        st(system="'email'", value=f"concat({value}, '@example.com')", use="'work'"),
    )


def practitioners(t: Tables) -> DataFrame:
    return entries(
        t.supplier, "s_suppkey", "Practitioner", "s_suppkey",
        name=_name("s_name", "concat('Given', s_suppkey)"),
        telecom=_phones("CASE WHEN s_acctbal > 5000 THEN 2 ELSE 1 END", "CAST(s_suppkey AS STRING)"),
        address=_home("concat('City ', s_nationkey)"),
        gender="CASE WHEN s_nationkey > 12 THEN 'male' ELSE 'female' END",
    )


def organizations(t: Tables) -> DataFrame:
    return entries(
        t.supplier, "s_suppkey", "Organization", "s_suppkey",
        name="s_name",
        type=arr(st(text="'Healthcare Provider'", coding=first_n(
            "CASE WHEN s_acctbal > 5000 THEN 2 ELSE 1 END", st(code="'prov'"), st(code="'hosp'")
        ))),
        telecom=_phones("CASE WHEN s_nationkey > 12 THEN 1 ELSE 0 END", "CAST(s_suppkey AS STRING)"),
        address=_home("concat('City ', s_nationkey)"),
    )


def _patient_fields() -> dict[str, str]:
    return dict(
        name=_name("c_name", "concat('Given', c_custkey)"),
        gender="CASE WHEN c_nationkey > 12 THEN 'male' ELSE 'female' END",
        birthDate="CAST(date_add(DATE'1950-01-01', CAST(c_custkey % 20000 AS INT)) AS STRING)",
        telecom=_phones("CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END", "CAST(c_custkey AS STRING)"),
        address=_home("concat('City ', c_nationkey)"),
        communication=arr(st(language=coded(("'en'", "'English'")))),
        maritalStatus=coded(("c_mktsegment", "'m'")),
        identifier=first_n(
            "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 3 END",
            st(type=st(coding=arr(st(code="CAST(NULL AS STRING)", display="'untyped'"))), value="'u'"),
            st(type=st(coding=arr(st(code="'MR'", display="'Medical Record'"))), value="c_name"),
            st(type=st(coding=arr(st(code="'SS'", display="'Social Security'"))), value="CAST(c_nationkey AS STRING)"),
        ),
        extension=arr(
            st(extension=arr(st(valueCoding=st(display="c_mktsegment")))),
            st(extension=f"filter({arr(st(valueCoding=st(display='c_name')))}, x -> false)"),
        ),
    )


def patients(t: Tables) -> DataFrame:
    return entries(t.customer, "c_custkey", "Patient", "c_custkey", **_patient_fields())


def people(t: Tables) -> DataFrame:
    """Practitioner and patient entries together."""
    return practitioners(t).unionByName(patients(t))
