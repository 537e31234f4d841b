"""Student records made up by rule, in wire form (all strings)."""

import math
import random

from riskloom.plans.students import IDENTITY_FIELDS, INTEGER_FIELDS, DOUBLE_FIELDS

FIELDS = [*IDENTITY_FIELDS, *INTEGER_FIELDS, *DOUBLE_FIELDS, "Target"]


def student(i: int, rng: random.Random, labelled: bool = True) -> dict:
    approved = rng.randint(1, 8)
    record = {f: str(rng.randint(1, 4)) for f in INTEGER_FIELDS}
    record |= {f: str(rng.randint(0, 9)) for f in DOUBLE_FIELDS}
    for term in ("1st", "2nd"):
        record[f"Curricular units {term} sem (approved)"] = str(approved)
    record |= {"Student ID": str(10_000_000 + i), "First Name": f"First{i}", "Last Name": f"Last{i}"}
    record["Age at enrollment"] = str(rng.randint(17, 40))
    chance = 1 / (1 + math.exp(4 - approved))
    word = "Enrolled" if rng.random() < 0.15 else ("Graduate" if rng.random() < chance else "Dropout")
    record["Target"] = word if labelled else None
    return {f: record[f] for f in FIELDS}


def students(n: int, seed: int = 7, labelled: bool = True, first: int = 0) -> list[dict]:
    rng = random.Random(seed)
    return [student(first + i, rng, labelled) for i in range(n)]


def frame(spark, records: list[dict]):
    schema = ", ".join(f"`{f}` string" for f in FIELDS)
    return spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in records], schema)
