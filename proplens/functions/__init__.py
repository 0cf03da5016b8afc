from proplens.functions.scalar import (  # noqa: F401
    PRICE_BANDS, band_label, band_order, clip_lower, coerce_numeric, finite_or_null,
    flag, format_money, format_percent, format_ratio, log1p_clipped, safe_divide, slug,
)
