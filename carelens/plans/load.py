"""The load job: CSV claim files → validated staging → star schema → ranking table.

Each step is one distributed write; the validated rows are checkpointed once
(to the shared checkpoint folder) so staging, star schema and ranking are all
built from the same validation pass.  All tables belong to one load and become
current together (see ``sources.snapshots``).  Like the reference's loader it stops
when no row is valid, and ``skip_validation`` keeps only the type checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model, ranking, states, validate
from ..operators.view import enriched
from ..session import ensure_checkpoint_dir
from ..sources import files, snapshots


class NoValidRows(ValueError):
    pass


def run_load(spark: SparkSession, csv_path: str, out_root: str,
             skip_validation: bool = False, keep_keys: bool = False) -> DataFrame:
    """Returns the reject summary of the load: rows read, valid, rejected, errors, and the first ten
    ``messages``.  Tables of the committed load: staging, rejected, the star's, ranking, and the states
    of ``operators.states`` (profile, moments, sketches, value_counts).  With ``keep_keys``
    members of the last load's dimensions keep their keys and new ones are numbered above them."""
    ensure_checkpoint_dir(spark)
    raw = files.read_numbered_csv(spark, csv_path)
    checked = validate.validate(raw, level="types" if skip_validation else "full",
                                record_col="line").checkpoint(eager=True)
    messages = [r["message"] for r in validate.first_errors(checked, 10, "line").collect()]
    summary = validate.reject_summary(checked).withColumn("messages", F.array(*map(F.lit, messages)).cast("array<string>"))
    if summary.first()["valid"] == 0:
        raise NoValidRows("\n  ".join(["no valid rows to load", *messages]))
    ok, rejected = validate.split(checked)
    load = snapshots.begin(spark, out_root)
    last = snapshots.last(spark, out_root) if keep_keys else None
    profile = states.ObservedProfile(ok.drop("line"))
    stg = load.write("staging", profile.rows)
    load.write("profile", profile.report())
    load.write("moments", states.moment_states(stg))
    load.write("sketches", states.sketch_states(stg))
    load.write("value_counts", states.value_states(stg))
    load.write("rejected", validate.as_strings(rejected))
    if last is None:
        dims = model.dimensions(stg)
    else:
        dims = model.extend_dimensions({n: last.read(spark, n) for n in ["Patient", *model.NAME_DIMENSIONS]}, stg)
    dims = {name: load.write(name, rows) for name, rows in dims.items()}
    load.write("Admission", model.build_fact(stg, dims))
    load.write("ranking", ranking.cheapest_insurer(enriched(stg)), "AgeGroup")  # a lookup reads the bands it needs
    load.commit()
    return summary
