from tessera.functions.clean import (ZONE_OFFSETS, change_hash, digits_only, drop_corrupt,
                                     is_not_corrupt, parse_zoned_timestamp, strip_currency,
                                     title_case, to_int, to_money, with_change_hash,
                                     with_clean_timestamp, with_currency, with_digits,
                                     with_title_case)

__all__ = ["ZONE_OFFSETS", "change_hash", "digits_only", "drop_corrupt", "is_not_corrupt",
           "parse_zoned_timestamp", "strip_currency", "title_case", "to_int", "to_money",
           "with_change_hash", "with_clean_timestamp", "with_currency", "with_digits",
           "with_title_case"]
