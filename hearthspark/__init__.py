"""Household survey analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames (or a small fitted
object that a second function applies), so operators chain with
``DataFrame.transform`` and Catalyst plans the whole job.
"""
