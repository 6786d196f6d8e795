"""Operators of a training-data pipeline: text, dialogue, url and token preparation at corpus scale.

The subpackage is optional: nothing else in ``ratebook`` imports it.
"""
