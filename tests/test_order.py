"""Report ordering (the driver's oracle comparison ignores order)."""

from costlens.operators import datasets as DS
from costlens.plans.period import Period
from costlens.sources.fixtures import load_fixture_sources

SF = "/root/testdata/sf0.01"
JAN = Period(1997, 1)


def _key(values):
    return tuple((v is None, v if v is not None else "") for v in values)


def test_invoices_sorted_by_date_number_chapter(spark):
    src = load_fixture_sources(spark, SF)
    rows = DS.invoices_by_chapter(src, None, None, JAN.month_start, JAN.month_end).collect()
    keys = [_key((r["fecha_factura"], r["numero_factura"], r["capitulo"])) for r in rows]
    assert len(keys) > 100 and keys == sorted(keys)


def test_unposted_docs_sorted_by_date_document(spark):
    src = load_fixture_sources(spark, SF)
    rows = DS.unposted_docs(src, None, None, JAN.month_start, JAN.month_end).collect()
    keys = [_key((r["fecha_factura"], r["document_no"])) for r in rows]
    assert len(keys) > 100 and keys == sorted(keys)
