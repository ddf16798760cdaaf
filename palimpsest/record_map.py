"""The declared record: its columns and the tree of its collections, made from shapes by one naming rule.

A shape is a nested dictionary from JSON property names to the width of a text, a Spark type, or another shape. Each leaf
is a column whose name is its path's parts in capitals, put together.
"""

from __future__ import annotations

from collections.abc import Iterator

from palimpsest.fieldmap import Collection, Field, FieldMap

BIT, DATE, INT, LONG, FLOAT = "boolean", "date", "int", "bigint", "double"
Shape = dict[str, "int | str | Shape"]

# Property names, widths and types of the record's JSON.


def coded(width: int) -> Shape:
    return {"code": width, "description": 255}


def listed(width: int) -> Shape:
    return {"activityLocation": 2, "code": width, "description": 255, "active": BIT}


STREET: Shape = {"streetNumber": 12, "address1": 50, "address2": 50, "city": 25, "state": listed(2)}
ADDRESS: Shape = STREET | {"foreignState": listed(2) | {"name": 80, "countryCode": 2}, "country": listed(2), "zip": 14}
NAME: Shape = {"firstName": 38, "middleInitial": 1, "lastName": 38}
CONTACT: Shape = NAME | {"title": 45, "phone": 15, "phoneExtension": 6, "email": 80}
PERSON: Shape = CONTACT | {"fax": 15, "language": listed(2), "address": ADDRESS}
PARTY: Shape = {"name": 80, "phone": 15, "phoneExtension": 6, "email": 80, "fax": 15, "becameCurrent": DATE, "endedCurrent": DATE, "address": ADDRESS, "type": coded(1), "notes": 4000, "publicNotes": 4000}
WASTE_FLAGS = """furnaceExemption mixedWasteGenerator onsiteBurnerExemption receivesOffSite recognizedTraderExporter recognizedTraderImporter
    recyclerActivity recyclerActivityNonStorage shortTermGenerator slabExporter slabImporter subPartKCollege subPartKHospital subPartKNonprofit
    subPartKWithdrawal subPartPHealthCare subPartPReverseDistributor subPartPWithdrawal transferFacility transporter tsd
    undergroundInjectionControl universalWasteDestinationFacility usImporter usedOilBurner usedOilMarketBurner usedOilProcessor usedOilRefiner
    usedOilSpecMarketer usedOilTransferFacility usedOilTransporter""".split()

RECORD: Shape = {
    "handlerId": 12,
    "activityLocation": 2,
    "type": coded(1) | {"sortOrder": LONG},
    "sequence": INT,
    "currentRecord": BIT,
    "extractFlag": BIT,
    "receivedDate": DATE,
    "handlerName": 80,
    "nonNotifier": coded(1),
    "acknowledgement": 1,
    "accessibility": coded(1),
    "siteLocation": ADDRESS | {"latitude": FLOAT, "longitude": FLOAT, "latLongPrimary": BIT, "gisOrigin": listed(2), "county": listed(5), "stateDistrict": listed(10), "standardized": BIT},
    "landType": coded(1),
    "siteMailingAddress": ADDRESS,
    "naics": {"primary": listed(6)},
    "contact": PERSON,
    "waste": {"federalGeneratorCategory": listed(1), "stateGeneratorCategory": listed(1), "shortTermGeneratorNotes": 4000} | dict.fromkeys(WASTE_FLAGS, BIT),
    "permit": {"contact": CONTACT | {"address": ADDRESS}, "facilityExistenceDate": DATE, "natureOfBusiness": 4000},
    "hsm": {"managed": BIT, "financialAssurance": BIT, "reason": coded(1), "effectiveDate": DATE},
    "lqgSiteClosure": {"compliance": BIT, "expectedClosureDate": DATE, "requestedClosureDate": DATE, "dateClosed": DATE, "closureType": coded(1)},
    "episodic": {"eventType": listed(1), "contactFirstName": 38, "contactMiddleInitial": 1, "contactLastName": 38, "contactPhone": 15, "contactPhoneExt": 6, "contactEmail": 80}
    | {"beginDate": DATE, "endDate": DATE, "rescind": BIT, "rescindComment": 4000},
    "comments": 4000,
    "publicComments": 4000,
    "updatedDate": DATE,
    "updatedBy": 100,
    "createdDate": DATE,
    "createdBy": 100,
    "lastRecord": BIT,
    "electronicManifestBroker": BIT,
    "brExempt": BIT,
    "includeInNationalReport": BIT,
    "reportCycle": INT,
}
#: path -> (the shape of an element, or the column of a bare text and its width; the collections inside it)
COLLECTIONS = {
    "additionalContacts": (PERSON | {"type": listed(2)}, {}),
    "owners": (PARTY, {}),
    "operators": (PARTY, {}),
    "certifications": (NAME | {"title": 45, "email": 80, "signDate": DATE}, {}),
    "lqgConsolidationsVsqgs": ({"handlerId": 12, "handlerName": 80} | STREET | {"zip": 14} | NAME | {"email": 80, "phone": 15, "phoneExtension": 6}, {}),
    "naics.other": (listed(6), {}),
    "siteLocation.stateDistrict.counties": (listed(5), {}),
    "waste.federalWasteCodes": (("FederalWasteCode", 6), {}),
    "waste.stateWasteCodes": (("StateWasteCode", 6), {}),
    "waste.universalWastes": ({"universalWaste": listed(10), "accumulated": BIT, "generated": BIT}, {}),
    "waste.stateActivities": (listed(5) | {"industryApp": BIT}, {}),
    "permit.otherPermits": ({"number": 50, "description": 255, "type": listed(1)}, {}),
    "hsm.activities": ({"facilityCode": listed(2), "estimatedShortTons": INT, "actualShortTons": INT, "landBasedUnit": coded(2)}, {"wasteCodes": (("WasteCode", 6), {})}),
    "episodic.wastes": ({"description": 4000, "quantity": FLOAT}, {"federalWasteCodes": (("FederalWasteCode", 6), {}), "stateWasteCodes": (("StateWasteCode", 6), {})}),
    "episodic.projects": ({"type": listed(3) | {"episodicType": listed(1)}, "otherDescription": 255}, {}),
}
#: Columns that aren't named by the rule.
NAMES = {"type.code": "SourceType", "type.description": "SourceTypeDescription", "createdBy": "SrcCreatedBy", "createdDate": "SrcCreatedDate", "updatedBy": "SrcUpdatedBy", "updatedDate": "SrcUpdatedDate", "type.sortOrder": "SourceTypeSortOrder"}
KEYS = ("HandlerId", "SourceType", "Sequence")


def column(path: str) -> str:
    return NAMES.get(path) or "".join(p[:1].upper() + p[1:] for p in path.split("."))


def leaves(shape: Shape, above: str = "") -> Iterator[tuple[str, int | str]]:
    """(path, width or type) of every leaf."""
    for name, kind in shape.items():
        if isinstance(kind, dict):
            yield from leaves(kind, f"{above}{name}.")
        else:
            yield above + name, kind


def fields(shape: Shape, keys: tuple[str, ...] = ()) -> tuple[Field, ...]:
    """A column for every leaf; one that is named as a part of the record's key is its element's own."""

    def field(path: str, kind: int | str) -> Field:
        name = column(path)
        name = f"Own{name}" if name in keys else name
        return Field(name, f"$.{path}", width=kind) if isinstance(kind, int) else Field(name, f"$.{path}", kind)

    return tuple(field(*leaf) for leaf in leaves(shape))


def collections(found: dict, depth: int = 0, above: str = "") -> tuple[Collection, ...]:
    def one(path: str, shape: Shape | tuple[str, int], inside: dict) -> Collection:
        name = above + column(path)
        own = fields(shape, KEYS) if isinstance(shape, dict) else (Field(shape[0], "$", width=shape[1]),)
        return Collection(name, f"$.{path}", own, collections(inside, depth + 1, name), ("Ordinal", "InnerOrdinal")[depth])

    return tuple(one(path, shape, inside) for path, (shape, inside) in found.items())


#: The record as it stands in an envelope, with its 18 collections.
DECLARED = FieldMap(KEYS, fields(RECORD), collections(COLLECTIONS), "Record")
