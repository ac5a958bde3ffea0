"""A static page of the catalogue: plate map and sorted entries."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import action_color, shape_label, well_id
from ..operators.records import catalog_counts, catalog_sorted, plate, plate_grid
from ..sources import files

#: Entries a page shows at most; a larger catalogue is for the tables, not for a page.
PAGE_ENTRIES = 50_000


def explorer_tables(entries: DataFrame) -> dict[str, DataFrame]:
    """The tables of the page: entries (sorted, with colour and shape), plate, wells (grid with counts), summary."""
    from ..functions.names import well_column, well_row

    rows = catalog_sorted(entries).withColumns({"color": action_color(F.col("action")), "shape_label": shape_label(F.col("axes"), F.col("shape"))})
    size = plate(entries)
    placed = entries.select(well_row(F.col("well")).alias("r"), well_column(F.col("well")).alias("c")).where("r IS NOT NULL").groupBy("r", "c").agg(F.count("*").alias("n"))
    wells = plate_grid(size, placed).withColumn("well", well_id(F.col("r"), F.col("c")))
    return {"entries": rows, "plate": size, "wells": wells, "summary": catalog_counts(entries)}


def write_explorer(entries: DataFrame, path: str, title: str = "Datasets") -> str:
    """Write the page; raises ValueError for a catalogue of more than PAGE_ENTRIES entries."""
    tables = explorer_tables(entries)
    summary, size = tables["summary"].first(), tables["plate"].first()
    if summary["datasets"] > PAGE_ENTRIES:
        raise ValueError(f"{summary['datasets']} entries are too many for a page")
    rows = [r.asDict() for r in tables["entries"].orderBy("pos").select("pos", "rel_path", "stem", "well", "action", "color", "shape_label", "analysis_rel").toLocalIterator()]
    wells = {r["well"]: r["n"] for r in tables["wells"].collect()}  # a plate's wells
    data = json.dumps({"entries": rows, "wells": wells}).replace("</", "<\\/")
    body = "".join(
        f'<tr><td>{html.escape(r["well"])}</td><td>{html.escape(r["action"])}</td><td><a href="{html.escape(r["rel_path"], quote=True)}">{html.escape(r["stem"])}</a></td><td>{html.escape(r["shape_label"])}</td></tr>' for r in rows
    )
    head = f'{summary["datasets"]} dataset(s), {summary["wells"]} well(s), {summary["actions"]} action(s); {size["label"]}'
    page = f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><p>{html.escape(head)}</p><table>{body}</table><script type="application/json" id="data">{data}</script>'
    files.write_bytes(path, page.encode())
    return path
