"""The sample bundle every extractor test starts from."""

PATIENT = ("urn:uuid:p1", {
    "resourceType": "Patient", "id": "p1",
    "name": [{"family": "Marks830", "given": ["Ann810"], "prefix": ["Ms."]}],
    "gender": "female", "birthDate": "2000-12-31",
    "address": [{"line": ["1 Elm St"], "city": "Salem", "state": "MA", "postalCode": "01970", "country": "US"}],
    "telecom": [{"system": "phone", "value": "555-0100", "use": "home"}],
    "maritalStatus": {"coding": [{"code": "M"}]},
    "communication": [{"language": {"coding": [{"display": "English"}]}}],
    "identifier": [{"value": "p1"}, {"type": {"coding": [{"code": "MR", "display": "Medical Record Number"}]}, "value": "mr-1"}],
    "extension": [{"extension": [{"valueCoding": {"display": "White"}}]}, {"valueString": "x"}],
})
ORGANIZATION = ("urn:uuid:o1", {
    "resourceType": "Organization", "name": "HOSPITAL A",
    "type": [{"text": "Healthcare Provider", "coding": [{"code": "prov"}]}],
    "telecom": [{"system": "phone", "value": "555-0101"}],
    "address": [{"line": ["2 Oak St"], "city": "Salem", "state": "MA", "postalCode": "01970", "country": "US"}],
})
PRACTITIONER = ("urn:uuid:d1", {
    "resourceType": "Practitioner", "gender": "male",
    "name": [{"family": "Lee1", "given": ["Bo2"], "prefix": ["Dr."]}],
    "telecom": [{"system": "email", "value": "a@example.com", "use": "work"},
                {"system": "phone", "value": "555-0102", "use": "work"}],
    "address": [{"line": ["3 Ash St"], "city": "Salem", "state": "MA", "postalCode": "01970", "country": "US"}],
})
ENCOUNTER = ("urn:uuid:e1", {
    "resourceType": "Encounter", "class": {"code": "AMB"},
    "type": [{"text": "Check-up", "coding": [{"code": "185345009", "display": "Check-up"}, {"code": "x2", "display": "Alt"}]}],
    "subject": {"reference": "urn:uuid:p1"},
    "period": {"start": "2020-01-01T23:30:00-05:00", "end": "2020-01-02T00:30:00-05:00"},
    "participant": [{"individual": {"reference": "Practitioner?identifier=sys|d1"}}, {"individual": {"reference": "urn:uuid:d2"}}],
    "serviceProvider": {"reference": "Organization?identifier=sys|o1"},
})
CLAIM = ("urn:uuid:c1", {
    "resourceType": "Claim", "status": "active", "use": "claim",
    "type": {"coding": [{"code": "institutional"}]}, "patient": {"reference": "urn:uuid:p1"},
    "billablePeriod": {"start": "2020-01-01T23:30:00-05:00", "end": "2020-01-02T00:30:00-05:00"},
    "created": "2020-01-02T00:30:00-05:00",
    "provider": {"reference": "Organization?identifier=sys|o1"},
    "priority": {"coding": [{"code": "normal"}]},
    "insurance": [{"sequence": 1, "focal": True, "coverage": {"display": "Plan A"}}],
    "item": [{"sequence": 1, "productOrService": {"coding": [{"code": "a"}, {"code": "b"}]}, "encounter": [{"reference": "urn:uuid:e1"}]},
             {"sequence": 2, "productOrService": {"coding": [{"code": "c"}, {"code": "d"}]}}],
    "total": {"value": 129.16, "currency": "USD"},
})
MEDICATION = ("urn:uuid:m1", {
    "resourceType": "MedicationRequest", "status": "active", "intent": "order",
    "medicationCodeableConcept": {"coding": [{"code": "860975", "display": "Metformin"}], "text": "Metformin 500"},
    "subject": {"reference": "urn:uuid:p1"}, "encounter": {"reference": "urn:uuid:e1"},
    "authoredOn": "2020-01-01T23:30:00-05:00", "requester": {"reference": "Practitioner?identifier=sys|d1"},
    "reasonReference": [{"reference": "urn:uuid:r1", "display": "Diabetes"}],
    "dosageInstruction": [{"sequence": 1, "asNeededBoolean": False,
                           "timing": {"repeat": {"frequency": 2, "period": 1.0, "periodUnit": "d"}},
                           "doseAndRate": [{"doseQuantity": {"value": 1.5}}]}],
})
BUNDLE = [PATIENT, ORGANIZATION, ENCOUNTER, CLAIM]
