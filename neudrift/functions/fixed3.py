"""Three-decimal text of doubles, rounded exactly as C's %.3f does."""

from pyspark.sql import DataFrame, functions as F


def with_fixed3(df: DataFrame, columns) -> DataFrame:
    """Replace each double column by its %.3f text; null becomes the empty string.

    The binary value decides, with ties to even, which neither round() nor format_string() gives.
    The fraction f = x - floor(x) is exact; f * 1000 is carried as the product plus its rounding
    error, the two halves of f coming from Dekker's splitting. The steps are separate projections
    so that each intermediate value is computed once. Valid below 2**63.
    """
    def stage(frame, **parts):
        return frame.withColumns({
            f"_{name}_{c}": F.expr(text.replace("@", c))
            for c in columns for name, text in parts.items()
        })

    df = stage(df, whole="floor(abs(`@`))", part="abs(`@`) - floor(abs(`@`))")
    df = stage(df, product="`_part_@` * 1000D",
               high="134217729D * `_part_@` - (134217729D * `_part_@` - `_part_@`)")
    df = stage(df, error="(`_high_@` * 1000D - `_product_@`) + (`_part_@` - `_high_@`) * 1000D",
               down="floor(`_product_@`)")
    df = stage(df, up="""
        CASE WHEN `_product_@` - `_down_@` > 0.5D THEN 1
             WHEN `_product_@` - `_down_@` < 0.5D THEN 0
             WHEN `_error_@` > 0D OR (`_error_@` = 0D AND `_down_@` % 2 = 1) THEN 1
             ELSE 0 END + `_down_@`""")
    text = """
        coalesce(concat(
            CASE WHEN `@` < 0D OR (`@` = 0D AND cast(`@` AS STRING) = '-0.0') THEN '-' ELSE '' END,
            cast(CASE WHEN `_up_@` = 1000 THEN `_whole_@` + 1 ELSE `_whole_@` END AS STRING),
            '.',
            lpad(cast(`_up_@` % 1000 AS STRING), 3, '0')), '')"""
    kept = [c for c in df.columns if not any(c.endswith(f"_{x}") and c.startswith("_") for x in columns)]
    return df.select(*[
        F.expr(text.replace("@", c)).alias(c) if c in columns else F.col(c) for c in kept
    ])
