from fieldlake.functions.exact import half_away, mean, rate
from fieldlake.functions.text import is_yes, parse_dates, same_text, upper_columns

__all__ = ["half_away", "is_yes", "mean", "parse_dates", "rate", "same_text", "upper_columns"]
