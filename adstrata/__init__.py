"""adstrata: advertising and marketing analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns) and stays lazy.
Dates such as "today" always come in as arguments.
"""

__version__ = "0.1.0"
