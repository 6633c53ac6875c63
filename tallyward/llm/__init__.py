"""Operators of a training-data pipeline: tokens, filters, near duplicates, secrets, quality, chats, scores, mixes.

Every operator reads only the columns it names, by exact name (``common.pick``): extra columns, whatever their names,
neither disturb it nor appear in its result. ``queries`` registers one query per operator.
"""
