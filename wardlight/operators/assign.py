"""Matching and assigning patients to care coordinators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.operators.lookups import available_coordinators, only_patients, patient_conditions
from wardlight.operators.ordering import distributed_row_number, ranked
from wardlight.session import settled
from wardlight.sources.clinical import ClinicalTables

# Match labels, and the specialty that earns the second one.
PERFECT, GENERAL, ANY = "Perfect Match", "General Match", "Available"
GENERALIST = "Geriatrics"

NO_SPECIALTY = "any"
# Ranges whose row counts reach the driver at once.
_RANGES = 4096
# Needs in the order they are served.
SPECIALTIES = ("CHF", "COPD", "Diabetes")


def _match(specialty: str | None) -> Column:
    return F.lit(False) if specialty is None else F.col("specialties").contains(specialty)


def best_per_specialty(tables: ClinicalTables, specialties: Sequence[str | None]) -> DataFrame:
    """The best free coordinator for each specialty, one row per specialty.

    A specialty match comes first, then free places, then the id; a
    generalist gets a label but no better place. All specialties are settled
    in one aggregation over the coordinators, which combines map-side.
    """
    free = available_coordinators(tables)
    choices = []
    for specialty in specialties:
        match = _match(specialty)
        quality = (F.when(match, PERFECT)
                   .when(F.col("specialties").contains(GENERALIST), GENERAL).otherwise(ANY))
        row = F.struct("coordinator_id", F.col("name").alias("coordinator_name"),
                       "available_capacity", quality.alias("match_quality"))
        order = F.struct(F.when(match, 1).otherwise(2), -F.col("available_capacity"),
                         F.col("coordinator_id"))
        choices.append(F.min_by(row, order))
    picked = free.agg(*(c.alias(f"c{i}") for i, c in enumerate(choices)))
    rows = F.array(*(F.struct(F.lit(s or NO_SPECIALTY).alias("specialty"), F.col(f"c{i}").alias("c"))
                     for i, s in enumerate(specialties)))
    return (picked.select(F.inline(rows)).where(F.col("c").isNotNull())
            .select("specialty", "c.coordinator_id", "c.coordinator_name",
                    "c.available_capacity", "c.match_quality"))


def suggest_coordinator(tables: ClinicalTables, patient_id: str, specialty: str | None) -> DataFrame:
    """The best coordinator for one patient."""
    return best_per_specialty(tables, [specialty]).select(
        F.lit(patient_id).alias("patient_id"), "coordinator_id", "coordinator_name",
        "available_capacity", "match_quality")


def suggest_coordinators(tables: ClinicalTables, needs: DataFrame,
                         specialties: Sequence[str | None]) -> DataFrame:
    """The best coordinator for every patient of ``needs`` (patient_id, specialty).

    Places are not used up: patients with the same need get the same person. A
    need that is not listed is met like no need at all. The looked-up side has
    one row per listed specialty, so it is broadcast.
    """
    best = F.broadcast(best_per_specialty(tables, [*specialties, None]).dropDuplicates(["specialty"]))
    listed = F.col("specialty").isin([s for s in specialties if s])
    return (needs.withColumn("specialty", F.when(listed, F.col("specialty")).otherwise(NO_SPECIALTY))
            .join(best, "specialty")
            .select("patient_id", "coordinator_id", "coordinator_name", "available_capacity",
                    "match_quality"))


def patient_needs(tables: ClinicalTables, conditions: Sequence[str] = SPECIALTIES,
                  patients: DataFrame | None = None) -> DataFrame:
    """Each patient's specialty need: the first listed condition the patient has."""
    flags = patient_conditions(tables, conditions, patients)
    need = F.coalesce(*(F.when(F.col(c.lower()), c) for c in conditions))
    return (only_patients(tables.patients.select("patient_id"), patients)
            .join(flags.select("patient_id", need.alias("specialty")), "patient_id", "left"))


def coordinator_slots(tables: ClinicalTables) -> DataFrame:
    """Every free place, numbered (``turn``) so that each round visits every coordinator once."""
    places = (
        available_coordinators(tables)
        .select("coordinator_id", "name", "specialties", "available_capacity", "years_experience",
                F.explode(F.sequence(F.lit(1), F.col("available_capacity"))).alias("slot")))
    return ranked(places, "turn", [
        F.col("slot"), F.desc("available_capacity"), F.desc("years_experience"),
        F.col("coordinator_id")])


def _counts_by_number(rows: DataFrame, number: str, low: int, width: int) -> dict[int, int]:
    """Rows per range of ``width`` numbers from ``low`` on; at most ``_RANGES`` ranges reach the driver."""
    inside = rows.where((F.col(number) >= low) & (F.col(number) < low + width * _RANGES))
    at = F.floor((F.col(number) - low) / width)
    return {r["at"]: r["n"] for r in inside.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}


def number_of_nth(rows: DataFrame, number: str, nth: int, highest: int) -> tuple[int, int]:
    """The ``number`` of the ``nth`` row (or of the last, if there are fewer), and how many rows there are.

    Numbers are counted in ranges, and the range that holds the row in finer ones, until a range is
    one number: one pass for some thousand numbers, two for some ten million.
    """
    low, width, before, total = 0, max(1, -(-(highest + 1) // _RANGES)), 0, None
    while True:
        counts = _counts_by_number(rows, number, low, width)
        if total is None:
            total = sum(counts.values())
            nth = min(nth, total)
            if not nth:
                return 0, total
        for at in sorted(counts):
            if before + counts[at] >= nth:
                break
            before += counts[at]
        low += at * width
        if width == 1:
            return low, total
        width = -(-width // _RANGES)


def _in_order(rows: DataFrame, number: str, step: Column) -> DataFrame:
    """``__step`` and ``__k``, the place in the order of ``number`` among the rows of the step."""
    return distributed_row_number(rows.withColumn("__step", step), "__k", ["__step"], [F.col(number)],
                                  {"__bucket": F.floor(F.col(number) / (1 << 14))})


def assign_coordinators(tables: ClinicalTables, patients: DataFrame,
                        specialties: Sequence[str] = SPECIALTIES) -> DataFrame:
    """Assignment of ``patients`` (patient_id, priority_score) by specialty within capacity.

    Specialties are served in order: patients who need one, by score and then
    id, take the free places of coordinators who list it, round by round. A
    place is used once. Whoever is left then takes any remaining place, and
    patients beyond the last place stay in the result without a coordinator.

    Both sides are ranked once. A specialty then takes the first of its patients and the first of
    the places left to it, so what it takes is told by two numbers, the last rank and the last
    turn; these are counted out range by range. With them every patient and place knows
    its step, one numbering within the steps serves all of them, and the two meet on step and
    number. Needs, ranked patients and ranked places are written to shared storage when this is
    called, each once.
    """
    needs = patient_needs(tables, specialties, patients)
    known = settled(patients.select("patient_id", "priority_score").join(
        needs, "patient_id", "left"), "needs")
    waiting = ranked(known, "priority_rank", [F.desc("priority_score"), F.col("patient_id")])
    places = coordinator_slots(tables)
    per_need = {r["specialty"]: r["n"] for r in waiting.groupBy("specialty").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    everyone, turns = sum(per_need.values()), places.count()
    served, used = F.lit(None).cast("int"), F.lit(None).cast("int")
    for step, specialty in enumerate(specialties):
        asking = per_need.get(specialty, 0)
        if not asking:
            continue
        fits = used.isNull() & F.col("specialties").contains(specialty)
        last_turn, free = number_of_nth(places.where(fits), "turn", asking, turns)
        last_rank = everyone
        if free < asking:
            last_rank, _ = number_of_nth(waiting.where(F.col("specialty") == specialty), "priority_rank",
                                         free, everyone)
        used = F.coalesce(used, F.when(fits & (F.col("turn") <= last_turn), step))
        served = F.coalesce(served, F.when(
            (F.col("specialty") == specialty) & (F.col("priority_rank") <= last_rank), step))
    rest = F.lit(len(specialties))
    asked = _in_order(waiting, "priority_rank", F.coalesce(served, rest))
    given = _in_order(places, "turn", F.coalesce(used, rest)).select(
        "__step", "__k", "coordinator_id", F.col("name").alias("coordinator_name"), "specialties")
    quality = (F.when(F.col("specialties").contains(F.col("specialty")), PERFECT)
               .when(F.col("specialties").contains(GENERALIST), GENERAL)
               .when(F.col("coordinator_id").isNotNull(), ANY))
    return (asked.join(given, ["__step", "__k"], "left")
            .select("patient_id", "priority_score", "priority_rank", "specialty",
                    "coordinator_id", "coordinator_name", quality.alias("match_quality")))


def coordinator_utilisation(tables: ClinicalTables, assignments: DataFrame) -> DataFrame:
    """Load of every coordinator before and after the assignment."""
    added = (assignments.where(F.col("coordinator_id").isNotNull())
             .groupBy("coordinator_id").agg(F.count(F.lit(1)).alias("assigned")))
    load = F.col("current_caseload") / F.col("max_caseload")
    after = (F.col("current_caseload") + F.col("assigned")) / F.col("max_caseload")
    return (tables.care_coordinators.select("coordinator_id", "current_caseload", "max_caseload")
            .join(added, "coordinator_id", "left")
            .withColumn("assigned", F.coalesce("assigned", F.lit(0).cast("bigint")))
            .select("coordinator_id", "current_caseload", "assigned",
                    F.round(load, 4).alias("load_before"), F.round(after, 4).alias("load_after")))
