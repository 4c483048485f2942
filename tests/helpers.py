"""Hand-written canonical sources for golden tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from costlens.sources.schema import TABLES

D = dt.date
TS = dt.datetime


def schema_of(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.dtype), True)
                         for c in TABLES[table].cols])


def make_sources(spark, **tables):
    """All canonical tables, empty unless rows (list of dicts) are given."""
    out = {}
    for name in TABLES:
        sch = schema_of(name)
        rows = tables.get(name, [])
        data = [tuple(r.get(f.name) for f in sch.fields) for r in rows]
        out[name] = spark.createDataFrame(data, sch)
    return out


def company(id_, name):
    return {"id": id_, "name": name}


def job(no, cid, desc=None):
    return {"No": no, "CompanyId": cid, "Description": desc}


def ledger(date, job_no, task, cost, cid="1", gppg="MATERIAL", doc=None):
    return {"Posting_Date": TS(date.year, date.month, date.day), "Gen_Prod_Posting_Group": gppg,
            "Job_No": job_no, "Job_Task_No": task, "Total_Cost_LCY": dec(cost),
            "Line_Amount_LCY": dec(cost), "CompanyId": cid, "Document_No": doc}


def dec(x):
    import decimal
    return None if x is None else decimal.Decimal(str(x))
