"""Operators for preparing large text corpora (chat formatting, rules, joins, packing, ...)."""
