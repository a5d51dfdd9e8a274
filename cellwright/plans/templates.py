"""Question and answer wording."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ---- fixed values: the wording of every question and answer, by function name ----
TEMPLATES: dict[str, tuple[str, str]] = {
    "find_value": (
        "Find the value in the given table, in row {row} column {col}\n<table>",
        "The value at Row {row} and Column {col} is {result}",
    ),
    "compare_rows_or_columns": (
        "Are {axis_name} {index1} and {axis_name} {index2} identical?\n<table>",
        "The {axis_name}s are{presence} identical",
    ),
    "non_empty_cells": (
        "What are the non-empty values in {axis_name} {index} present from index {slice_start} to index {slice_end}?\n<table>",
        "The non-empty values in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "unique_values": (
        "What are the unique values in {axis_name} {index} (showing slice from index {slice_start} to {slice_end})?\n<table>",
        "The unique values in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "value_present": (
        "Is the value {value} present in {axis_name} {index}?\n<table>",
        "The value {value} is{presence} present in {axis_name} {index}",
    ),
    "fetch_neighbors": (
        "What are the neighboring values for the cell at row {row} and column {col}?\n<table>",
        "The neighboring values are: {result}",
    ),
    "top_n_values": (
        "What are the top {n} values in {axis_name} {index}?\n<table>",
        "The top {n} values in {axis_name} {index} are: {result}",
    ),
    "bottom_n_values": (
        "What are the bottom {n} values in {axis_name} {index}?\n<table>",
        "The bottom {n} values in {axis_name} {index} are: {result}",
    ),
    "sort_values": (
        "What are the values in {axis_name} {index} sorted in {order} order? Return the slice from index {slice_start} to {slice_end}.\n<table>",
        "The sorted values in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "max_min_value": (
        "What are the maximum and minimum values in {axis_name} {index}?\n<table>",
        "The maximum value is {max_val} and the minimum value is {min_val}",
    ),
    "add_cells": (
        "What is the sum of values at positions {cell1} and {cell2}?\n<table>",
        "The sum of the values is {result}",
    ),
    "subtract_cells": (
        "What is the difference between values at positions {cell1} and {cell2}?\n<table>",
        "The difference between the values is {result}",
    ),
    "sum_values": (
        "What is the sum of all values in {axis_name} {index}?\n<table>",
        "The sum of values in {axis_name} {index} is {result}",
    ),
    "add_constant": (
        "What are the values after adding {constant} to {axis_name} {index} present from the index {slice_start} to index {slice_end}?\n<table>",
        "The values after adding {constant} in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "table_shape": (
        "What are the dimensions of the table?\n<table>",
        "The table has {rows} rows and {cols} columns",
    ),
    "has_missing_values": (
        "Are there any missing values in {axis_name} {index}?\n<table>",
        "There {presence} missing values in {axis_name} {index}",
    ),
    "count_empty_cells": (
        "How many empty cells are in {axis_name} {index}?\n<table>",
        "There are {result} empty cells in {axis_name} {index}",
    ),
    "fill_missing_values": (
        "What are the values after filling missing values with {value} in {axis_name} {index} present from the index {slice_start} to index {slice_end}?\n<table>",
        "The values after filling missing values with {value} in {axis_name} {index} present from the index {slice_start} to index {slice_end} are: {result}",
    ),
    "find_all_cells_with_value": (
        "Where does the value {value} appear in the table?\n<table>",
        "The value {value} appears at positions: {result}",
    ),
    "count_value_occurrences": (
        "How many times does the value {value} appear in the table?\n<table>",
        "The value {value} appears {result} times",
    ),
    "sum_table_values": (
        "What is the sum of all values in the table?\n<table>",
        "The sum of all values is {result}",
    ),
    "average_table_values": (
        "What is the average of all values in the table?\n<table>",
        "The average of all values is {result}",
    ),
    "cumulative_sum": (
        "What is the cumulative sum of values in {axis_name} {index}? Only show the slice from index {slice_start} to {slice_end}.\n<table>",
        "The cumulative sum in {axis_name} {index} from index {slice_start} to {slice_end} is: {result}",
    ),
    "successive_differences": (
        "What are the differences between successive values in {axis_name} {index} (showing slice from index {slice_start} to {slice_end})?\n<table>",
        "The successive differences in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "value_range": (
        "What is the range of values in {axis_name} {index}?\n<table>",
        "The range of values is {result}",
    ),
    "mean_value": (
        "What is the mean value of {axis_name} {index}?\n<table>",
        "The mean value is {result}",
    ),
    "median_value": (
        "What is the median value of {axis_name} {index}?\n<table>",
        "The median value is {result}",
    ),
    "mode_value": (
        "What is the most frequent value in {axis_name} {index}?\n<table>",
        "The most frequent value is {result}",
    ),
    "square_values": (
        "What are the squared values in {axis_name} {index}? Return the slice from index {slice_start} to {slice_end}.\n<table>",
        "The squared values in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "sqrt_values": (
        "What are the square roots of non negative values in {axis_name} {index} (showing slice from index {slice_start} to {slice_end})?\n<table>",
        "The square roots in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "abs_values": (
        "What are the absolute values in {axis_name} {index} present in the slice from index {slice_start} to index {slice_end}?\n<table>",
        "The absolute values in {axis_name} {index} from index {slice_start} to {slice_end} are: {result}",
    ),
    "direct_correlation_between_columns": (
        "What is the pearson correlation coefficient between column {col1} and column {col2} in the table?\n<table>",
        "The pearson correlation coefficient between column {col1} and column {col2} in the table is {correlation}.",
    ),
    "stepwise_correlation_between_columns": (
        "In a stepwise fashion, calculate and explain the correlation coefficient between column {col1} and column {col2} of the table.\n<table>",
        """Let me explain the correlation calculation between column {col1} and column {col2} of the given table in a step by step manner:

            1. First, I analyzed all {n_samples} valid data points by excluding any missing values.

            2. I calculated the means:
            - Mean of column {col1}: {x_mean}
            - Mean of column {col2}: {y_mean}

            3. Then, I calculated:
            - Sum of products of deviations: {sum_product_dev}
            - Sum of squared deviations for column {col1}: {sum_squared_dev_x}
            - Sum of squared deviations for column {col2}: {sum_squared_dev_y}

            4. Finally, I computed the correlation coefficient using the formula:
            correlation = sum_product_dev / sqrt(sum_squared_dev_x * sum_squared_dev_y)

            The final correlation coefficient is {correlation}.

            This means that the two columns have a correlation of {correlation}.""",
    ),
    "transform_column": (
        "Transform column {col} of the table using the {method} transformation. Return the slice from index {slice_start} to {slice_end}.\n<table>",
        "Here's a sample of the transformed values of column {col} from the table, using the {method} transformation (indices {slice_start} to {slice_end}): {result}.",
    ),
    "stepwise_transform_column": (
        "Explain the {method} transformation process for column {col} for the given table. Make sure you return values from index {slice_start} to index {slice_end}.\n<table>",
        """Let me explain the {method} transformation process for column {col} of the given table in a step by step manner:

            1. Original Data Statistics:
                - Mean: {mean}
                - Standard Deviation: {std}
                - Min: {min}
                - Max: {max}
                - Median: {median}

            2. Transformation Process:
            {transformation_steps}

            3. Transformed Data Statistics:
            {transformed_stats}

            4. Key Properties of this Transformation:
            {properties}

            5. Sample of transformed values (indices {slice_start} to {slice_end}):
            {result}""",
    ),
    "log_transform_column": (
        "Apply the log transformation to the absolute values of column {col} of the table. Return the slice from index {slice_start} to {slice_end}.\n<table>",
        "Here's a sample of the log-transformed values of the absolute values for column {col} from the table, from index {slice_start} to index {slice_end}: {result}",
    ),
    "infer_feature_causality": (
        "In the given table, is there any causal relationship between features {source_feature} and {sink_feature}? Meaning, does feature {source_feature} cause feature {sink_feature}?\n<table>",
        "{is_causal}, there is {sentence_filler} causal relationship between feature {source_feature} and feature {sink_feature}.",
    ),
}

# ---- fixed values: the parts of the scaling explanation, by method ----
SCALING_STEPS = {
    "normalize": """   - Minimum value: {min}
                        - Maximum value: {max}
                        - Formula: (x - min) / (max - min)""",
    "standardize": """   - Mean: {mean}
                        - Standard deviation: {std}
                        - Formula: (x - mean) / std""",
    "robust_scale": """   - Median: {median}
                        - Q1 (25th percentile): {q1}
                        - Q3 (75th percentile): {q3}
                        - IQR: {iqr}
                        - Formula: (x - median) / IQR""",
}
SCALING_STATS = {
    "normalize": """   - Minimum: {after_min} (should be 0)
                        - Maximum: {after_max} (should be 1)
                        - Mean: {after_mean}""",
    "standardize": """   - Mean: {after_mean} (should be ~0)
                        - Standard deviation: {after_std} (should be ~1)""",
    "robust_scale": """   - Median: {after_median}
                        - IQR: {after_iqr}""",
}
SCALING_PROPERTIES = {
    "normalize": """   - All values are scaled to range [0, 1]
                        - Preserves zero values
                        - Preserves distribution shape""",
    "standardize": """   - Centered around zero
                        - Unit variance
                        - Preserves outliers
                        - Useful for normally distributed features""",
    "robust_scale": """   - Robust to outliers
                        - Based on percentiles
                        - Preserves zero values
                        - Useful for data with outliers""",
}

CAUSAL = "infer_feature_causality"
#: functions a table without causal records may be asked about, in name order
DRAWABLE = sorted(f for f in TEMPLATES if f != CAUSAL)


def pieces(template: str) -> list[tuple[str, bool]]:
    """Split into (text, False) and (placeholder, True)."""
    out = []
    for part in re.split(r"(\{\w+\})", template):
        if re.fullmatch(r"\{\w+\}", part):
            out.append((part[1:-1], True))
        elif part:
            out.append((part, False))
    return out


def fill(template: str, params: dict[str, Column]) -> Column:
    """The template with its placeholders replaced; NULL when one is NULL."""
    return F.concat(*[params[p] if is_name else F.lit(p) for p, is_name in pieces(template)])


def choose(key: Column, options: dict[str, Column]) -> Column:
    """The option named by ``key``; NULL for other names."""
    out = None
    for name, value in options.items():
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return out


def templates(spark: SparkSession, extra=None) -> DataFrame:
    """fn, question, answer and the same cut into pieces; a few dozen fixed rows."""
    rows = [
        (name, q, a, pieces(q), pieces(a))
        for name, (q, a) in {**TEMPLATES, **(extra or {})}.items()
    ]
    cut = "array<struct<text:string,is_name:boolean>>"
    return spark.createDataFrame(
        rows, f"fn string, question string, answer string, question_pieces {cut}, answer_pieces {cut}"
    )


def fill_pieces(parts: Column, params: Column) -> Column:
    """Join the pieces, placeholders looked up in the map; NULL when one is missing."""
    texts = F.transform(parts, lambda p: F.when(p["is_name"], F.try_element_at(params, p["text"])).otherwise(p["text"]))
    return F.when(~F.exists(texts, lambda s: s.isNull()), F.array_join(texts, ""))
