"""Compositions of operators into loads, and the table writer."""
