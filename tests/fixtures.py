"""Small hand-written inputs shaped like FIXTURES.md (values ours)."""

import json


def user(uid: str, first: str = "Ann", age: int = 30, city: str = "Austin"):
    return {
        "cell": f"({uid[:3]})-{uid[3:5]}-1234",
        "email": f"{first.lower()}@example.com",
        "name": {"first": first},
        "dob": {"age": age},
        "login": {"username": uid},
        "location": {
            "city": city, "state": "TX", "country": "US",
            "timezone": {"offset": "-6:00", "description": "Central"},
            "coordinates": {"latitude": "30.2", "longitude": "-97.7"},
        },
    }


DOCS = [
    # two results in one document
    json.dumps({"info": {"page": "p1"}, "results": [user("04715"), user("02000", "Bob", 40, "Dallas")]}),
    # empty results
    json.dumps({"info": {"page": "p2"}, "results": []}),
    # results null
    json.dumps({"info": {"page": "p3"}, "results": None}),
    # page null -> dropped
    json.dumps({"info": {"page": None}, "results": [user("04715")]}),
    # no info at all -> dropped
    json.dumps({"results": [user("04715")]}),
    # extra unknown field
    json.dumps({"info": {"page": "p4", "seed": "x"}, "results": [user("03000", "Cy")], "extra": 1}),
    # multi-line document
    json.dumps({"info": {"page": "p5"}, "results": [user("04715", "Ann")]}, indent=2),
    # malformed
    '{"info": {"page": "p6"}, "results": [',
]

LOG_LINES = [
    # user 04715: Nov before Apr by date, but 'Apr' < 'Nov' as text
    "04715,1.1.1.1,23/Nov/2011:17:41:05 -0500,23,Nov,11,2011,17,41,05,-0500,PUT,/start,0,/start,agent,100",
    "04715,1.1.1.2,02/Apr/2012:09:00:00 -0500,02,Apr,04,2012,09,00,00,-0500,GET,/b,0,/b,agent,404",
    # user 02000: non-numeric status
    "02000,2.2.2.2,01/Jan/2012:00:00:00 -0500,01,Jan,01,2012,00,00,00,-0500,POST,/c,0,/c,agent,n/a",
]

PROFILE = [("04715", 33, "engineer"), ("02000", 41, "teacher")]  # 03000 missing
STATUS = [(100, "Informational", "Continue"), (404, "Client error", "Not found")]
