"""Operators for preparing training text: filters, duplicates, tokens, packing, chat and licence scans."""
