"""Inputs and outputs of the job.

``Sources`` bundles the five logical inputs. ``catalog.read_sources`` reads
them from tables or files and conforms them to ``zerobill.schemas``;
``fixture.fixture_sources`` derives them from the driver's test tables.
``sinks`` holds the writers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Sources:
    customer: DataFrame
    billing_line: DataFrame
    tax_line_1: DataFrame
    tax_line_2: DataFrame
    alarm_factor: DataFrame

    def tax_lines(self) -> dict[int, DataFrame]:
        """Tax lines per billing system, numbered as in the source names."""
        return {2: self.tax_line_2, 1: self.tax_line_1}


__all__ = ["Sources"]
