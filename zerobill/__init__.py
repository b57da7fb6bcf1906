"""zerobill: monthly zero-amount-invoice level alarms on Spark DataFrames.

The package is organised like a Spark job:

* ``sources``   – typed readers for the five logical inputs, the test-table
                  adapter, and the sinks (ORC create/overwrite, positional append).
* ``functions`` – ``Column -> Column`` business expressions (segment, state key,
                  month keys, variations, level limits, alarm flag/label).
* ``operators`` – ``DataFrame -> DataFrame`` relational steps (roll-ups, joins,
                  zero-invoice filter, month pivot, alarm grains).
* ``plans``     – the whole monthly job wired together and the query registry.
"""

from zerobill.run import RunContext

__all__ = ["RunContext"]
