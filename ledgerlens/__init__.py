"""ledgerlens: blockchain-ledger analytics as Spark DataFrame plans.

Sub-packages
  sources    raw ledger text and registry readers, legacy result readers
  functions  Column -> Column helpers (strict integers, month labels, ...)
  operators  generic aggregate / join / top-k / reshape operators
  plans      the named analyses, star-schema mirrors and SQL statements
  streaming  the monthly analyses over a growing folder of raw files
"""

__version__ = "0.1.0"
