"""Workbooks as long cells ``(sheet, row, col, value)``: workflows, sequences, models, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from agrimill.functions import labels, numbers, text
from agrimill.operators import runs
from agrimill.specs import LABEL, TableSpec

WORKFLOWS = TableSpec(
    "technical_workflows", "technical_workflows",
    "reference_name string, family string, production_reference_name string, production_system string, start_day int, "
    "start_month int, unit string, life_state string, life_cycle string, plant_density int, translation_id string",
    pk=("reference_name",), not_null=("translation_id",),
    fks={"production_reference_name": ("master_productions", "reference_name")},
)
PROCEDURES = TableSpec(
    "technical_workflows", "technical_workflow_procedures",
    f"reference_name string, position int, name {LABEL}, repetition int, frequency string, period string, bbch_stage string, "
    "procedure_reference string, technical_workflow_id string",
    pk=("reference_name",), not_null=("position", "name", "procedure_reference", "technical_workflow_id"),
    fks={"technical_workflow_id": ("technical_workflows", "reference_name")},
)
ITEMS = TableSpec(
    "technical_workflows", "technical_workflow_procedure_items",
    "reference_name string, actor_reference string, procedure_item_reference string, article_reference string, "
    "quantity decimal(19,4), unit string, procedure_reference string, technical_workflow_procedure_id string",
    pk=("reference_name",), not_null=("procedure_reference", "technical_workflow_procedure_id"),
    fks={"technical_workflow_procedure_id": ("technical_workflow_procedures", "reference_name")},
)
SEQUENCES = TableSpec(
    "technical_workflow_sequences", "technical_sequences",
    "reference_name string, family string, production_reference_name string, production_system string, translation_id string",
    pk=("reference_name",), not_null=("production_reference_name", "translation_id"),
    fks={"production_reference_name": ("master_productions", "reference_name")},
)
SEQUENCE_STEPS = TableSpec(
    "technical_workflow_sequences", "technical_workflow_sequences",
    "technical_sequence_id string, year_start int, year_stop int, technical_workflow_id string",
    not_null=("technical_sequence_id", "technical_workflow_id"),
    fks={
        "technical_workflow_id": ("technical_workflows", "reference_name"),
        "technical_sequence_id": ("technical_sequences", "reference_name"),
    },
)
MODELS = TableSpec(
    "intervention_models", "intervention_models",
    f"reference_name string, name {LABEL}, category_name {LABEL}, number string, procedure_reference string, "
    "working_flow decimal(19,4), working_flow_unit string",
    pk=("reference_name",), not_null=("procedure_reference",),
)
MODEL_ITEMS = TableSpec(
    "intervention_models", "intervention_model_items",
    "reference_name string, procedure_item_reference string, article_reference string, indicator_name string, "
    "indicator_value decimal(19,4), indicator_unit string, intervention_model_id string",
    pk=("reference_name",), not_null=("procedure_item_reference",),
    fks={"intervention_model_id": ("intervention_models", "reference_name")},
)
BUDGETS = TableSpec(
    "budgets", "master_budgets",
    "activity_family string, budget_category string, variant string, mode string, proportionnal_key string, repetition int, "
    "frequency string, start_month int, quantity decimal(8,2), unit_pretax_amount decimal(8,2), tax_rate decimal(8,2), "
    "unit string, direction string",
    not_null=(
        "activity_family", "budget_category", "variant", "repetition", "frequency", "start_month", "quantity", "unit_pretax_amount",
        "tax_rate", "unit", "direction",
    ),
    fks={"variant": ("master_variants", "reference_name"), "unit": ("master_units", "reference_name")},
)
SPECS = [WORKFLOWS, PROCEDURES, ITEMS, SEQUENCES, SEQUENCE_STEPS, MODELS, MODEL_ITEMS, BUDGETS]

LETTERS = list("ABCDEFGHIJKLM")


def _text(cell: str) -> Column:
    """Cell as text, a blank one as ''."""
    return F.coalesce(F.col(cell), F.lit(""))


def _given(cell: str) -> Column:
    return F.trim(_text(cell)) != ""


def _header(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.filter(F.col("row") == 2).select("sheet", *[F.col(c).alias(n) for c, n in names.items()])


def _lines(cells: DataFrame) -> DataFrame:
    return runs.sheet_rows(cells, LETTERS)


HEADER = {"A": "family", "B": "production", "C": "production_system", "D": "title"}


def _with_ids(cells: DataFrame, names: dict[str, str], first_line: int) -> DataFrame:
    return runs.with_header_line(_lines(cells), ["sheet"], 2, names, first_line)


def _workflow_id(sheet: str = "sheet") -> Column:
    return F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("")) for c in ("family", "production", "production_system", sheet)])


def workflows(cells: DataFrame) -> DataFrame:
    """One workflow per sheet, from its second row."""
    names = {**HEADER, "E": "day", "F": "unit", "G": "state", "H": "cycle", "I": "density"}
    h = _header(_lines(cells), names)
    day = F.to_date("day")
    return WORKFLOWS.align(
        h.select(
            _workflow_id().alias("reference_name"), "family", F.col("production").alias("production_reference_name"), "production_system",
            F.dayofmonth(day).alias("start_day"), F.month(day).alias("start_month"), "unit",
            text.default_if_blank(F.col("state"), "1").alias("life_state"), text.default_if_blank(F.col("cycle"), "annual").alias("life_cycle"),
            F.when(F.trim(F.coalesce("density", F.lit(""))) != "", numbers.leading_int(F.col("density"))).alias("plant_density"),
            F.concat(F.lit("technical_workflows_"), _workflow_id()).alias("translation_id"),
        )
    )


def _titles(h: DataFrame, scope: str, key: Column) -> DataFrame:
    title = F.replace(F.coalesce("title", F.lit("")), F.lit("'"), F.lit(" "))
    return h.select(F.lit(scope).alias("scope"), F.concat(F.lit(f"{scope}_"), key).alias("id"), title.alias("fra"), title.alias("eng"))


def workflow_translations(cells: DataFrame) -> DataFrame:
    return _titles(_header(_lines(cells), HEADER), "technical_workflows", _workflow_id())


def _workflow_lines(cells: DataFrame) -> DataFrame:
    names = {"A": "family", "B": "production", "C": "production_system"}
    lines = _with_ids(cells, names, 4).filter(_given("A"))
    position = numbers.leading_int(F.col("A"))
    return lines.withColumns({
        "workflow": _workflow_id(), "position": position,
        "procedure": F.concat_ws("_", _workflow_id(), _text("B"), position.cast("string")),
    })


def procedures(cells: DataFrame) -> DataFrame:
    """A procedure starts where position and name differ from the line before."""
    lines = _workflow_lines(cells)
    heads = runs.run_heads(lines, ["sheet"], "row", F.concat_ws("_", F.col("position").cast("string"), _text("B")))
    repetition = F.when(_given("C"), numbers.leading_int(F.col("C"))).otherwise(1)
    return PROCEDURES.align(
        heads.select(
            F.col("procedure").alias("reference_name"), "position", labels.label_or_null(_text("B")).alias("name"),
            repetition.alias("repetition"), text.default_if_blank(F.col("D"), "per_year").alias("frequency"),
            text.default_if_blank(F.col("E"), "0").alias("period"), text.default_if_blank(F.col("L"), "-").alias("bbch_stage"),
            _text("F").alias("procedure_reference"), F.col("workflow").alias("technical_workflow_id"),
        )
    )


def procedure_items(cells: DataFrame) -> DataFrame:
    """Lines that name an actor; the item keeps the procedure's name as its reference."""
    lines = _workflow_lines(cells).filter(_given("G"))
    return ITEMS.align(
        lines.select(
            F.concat_ws("_", "procedure", _text("H"), _text("I")).alias("reference_name"), F.col("G").alias("actor_reference"),
            _text("H").alias("procedure_item_reference"), _text("I").alias("article_reference"),
            numbers.leading_float(F.col("J")).cast("decimal(19,4)").alias("quantity"), _text("K").alias("unit"),
            _text("B").alias("procedure_reference"), F.col("procedure").alias("technical_workflow_procedure_id"),
        )
    )


def sequences(cells: DataFrame) -> DataFrame:
    h = _header(_lines(cells), HEADER)
    return SEQUENCES.align(
        h.select(
            F.col("sheet").alias("reference_name"), "family", F.col("production").alias("production_reference_name"), "production_system",
            F.concat(F.lit("technical_sequences_"), "sheet").alias("translation_id"),
        )
    )


def sequence_translations(cells: DataFrame) -> DataFrame:
    return _titles(_header(_lines(cells), HEADER), "technical_sequences", F.col("sheet"))


def sequence_steps(cells: DataFrame) -> DataFrame:
    lines = _with_ids(cells, {"A": "family", "B": "production"}, 4).filter(_given("A"))
    workflow = F.concat_ws("_", F.coalesce("family", F.lit("")), F.coalesce("production", F.lit("")), _text("C"))
    return SEQUENCE_STEPS.align(
        lines.select(
            F.col("sheet").alias("technical_sequence_id"), numbers.leading_int(F.col("A")).alias("year_start"),
            numbers.leading_int(F.col("B")).alias("year_stop"), workflow.alias("technical_workflow_id"),
        )
    )


def _model_lines(cells: DataFrame) -> DataFrame:
    lines = _lines(cells).filter((F.col("row") >= 2) & _given("A"))
    return lines.withColumn("model", F.replace(_text("D"), F.lit(","), F.lit("_")))


def models(cells: DataFrame) -> DataFrame:
    """A model starts where its id differs from the line before; the sheet is its category."""
    heads = runs.run_heads(_model_lines(cells), ["sheet"], "row", F.col("model"))
    return MODELS.align(
        heads.select(
            F.col("model").alias("reference_name"), labels.label_or_null(_text("B")).alias("name"),
            labels.label_or_null(F.col("sheet")).alias("category_name"), F.col("A").alias("number"),
            _text("C").alias("procedure_reference"), numbers.leading_float(F.col("J")).cast("decimal(19,4)").alias("working_flow"),
            text.default_if_blank(F.col("K"), "").alias("working_flow_unit"),
        )
    )


def model_items(cells: DataFrame) -> DataFrame:
    lines = _model_lines(cells)
    return MODEL_ITEMS.align(
        lines.select(
            F.concat_ws("_", "model", _text("E"), _text("F")).alias("reference_name"), _text("E").alias("procedure_item_reference"),
            _text("F").alias("article_reference"), text.default_if_blank(F.col("G"), "").alias("indicator_name"),
            numbers.leading_float(F.col("H")).cast("decimal(19,4)").alias("indicator_value"),
            text.default_if_blank(F.col("I"), "").alias("indicator_unit"), F.col("model").alias("intervention_model_id"),
        )
    )


def budgets(cells: DataFrame) -> DataFrame:
    """One budget line per sheet row with a category; the sheet is the activity family."""
    lines = _lines(cells).filter((F.col("row") >= 2) & _given("A"))

    def amount(cell: str) -> Column:
        return F.round(numbers.leading_float(F.col(cell)), 2).cast("decimal(8,2)")

    return BUDGETS.align(
        lines.select(
            F.col("sheet").alias("activity_family"), _text("A").alias("budget_category"), _text("C").alias("variant"),
            _text("D").alias("mode"), _text("E").alias("proportionnal_key"), numbers.leading_int(F.col("F")).alias("repetition"),
            _text("G").alias("frequency"), numbers.leading_int(F.col("H")).alias("start_month"), amount("I").alias("quantity"),
            amount("J").alias("unit_pretax_amount"), amount("K").alias("tax_rate"), _text("L").alias("unit"), _text("M").alias("direction"),
        )
    )
