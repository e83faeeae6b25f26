"""What keeps memory bounded where pages are many or large."""

import pyarrow as pa

from checks import landed
from gleanery.sources import dom, registry, tabular
from gleanery.sources.postings import accepted


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_detail_pages_are_not_broadcast(spark):
    """The planner takes html for a few bytes a row, so a join by its estimate would send all pages to the driver."""
    row = "<tr><td>R{}</td><td>Nurse - Kisumu</td><td>Contract</td><td>1</td><td>x</td><td>G</td><td>Active</td></tr>"
    lists = spark.createDataFrame(
        [(1, f"<table><tr><th>Ref</th></tr>{''.join(row.format(k) for k in range(3))}</table>")], "page int, html string")
    need = "<tr><td>1</td><td>Care{0}<table><tr><td>in {0}</td></tr></table></td><td>Must</td></tr>"
    details = spark.createDataFrame(
        [(f"R{k}", "<h4>Key Responsibilities:</h4><p>Look after everyone on the ward each day</p><h4>Vacancy Requirements:</h4>"
          f"<table><tr><th>Need</th></tr>{need.format(k)}</table>") for k in range(4) if k != 1], "ref string, html string")
    found = tabular.institute_postings(lists, details, "https://v.test")
    assert "BroadcastHashJoin" not in plan_of(found)
    got = {r.external_id: (r.requirements, r.reject) for r in found.collect()}
    # The cells of an inner table are cells of the row around it too.
    assert got == {"kemri_R0": ("[in 0] Care0in 0", None), "kemri_R1": ("", "no detail page"),
                   "kemri_R2": ("[in 2] Care2in 2", None)}


def test_cells_look_at_their_own_nodes():
    """Rows, cells and texts are sought in slices; a search of the whole page for each was quadratic."""
    sql = dom.table_cells("nodes", "table")
    assert sql.count("slice(nodes") == 3 and "filter(nodes" not in sql


def test_pages_are_parsed_in_pieces(monkeypatch):
    """A worker holds the nodes of a piece of a batch, however many pages the batch has."""
    pages = ["<p>a</p>"] * 5 + [None] + ["<b>" + "x" * 5000 + "</b>"] * 3 + ["<p>z</p>"] * 40 + [""]
    monkeypatch.setattr(dom, "PIECE", 4096)
    monkeypatch.setattr(dom, "PIECE_PAGES", 16)
    held, columnar = [], dom._columnar
    monkeypatch.setattr(dom, "_columnar", lambda found: held.append(len(found)) or columnar(found))
    got = list(dom.parse_nodes.func(iter([pa.array(pages), pa.array([], pa.string()), pa.array(pages[:3])])))
    assert sum(held) == len(pages) + 3 and max(held) <= 16 and len(held) > 6
    flat = [n for piece in got for n in piece.to_pylist()]
    assert flat == columnar([dom._nodes_of(h) for h in pages + pages[:3]]).to_pylist()


def test_usable_rows_are_extracted_once(spark, sf):
    """The check for usable rows stays above the extraction: as a filter it would repeat it below."""
    pages = landed.card_pages(spark, sf, ("linkedin",))
    rows = accepted(registry.extract(registry.Landed(pages=pages), ["linkedin"])).select("title", "url")
    optimised = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in optimised.splitlines() if "Filter " in line and "lambda" in line]
    assert rows.count() == 200
