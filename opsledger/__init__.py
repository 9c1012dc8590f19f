"""opsledger: DataFrame operators and jobs for clinic operations data.

Every public function takes DataFrames (or Columns) and returns a lazy
DataFrame (or Column); nothing in the core collects rows to the driver.
"""
