"""Monthly staff and branch performance standings, computed on Spark.

``standings.operators``  DataFrame -> DataFrame building blocks
``standings.functions``  Column helpers the operators share
``standings.sources``    schemas, staged tables and sinks
``standings.plans``      the monthly report and the job that publishes it
"""

from standings.plans.report import Options, RankingInputs, RankingRun, ranking_report

__all__ = ["Options", "RankingInputs", "RankingRun", "ranking_report"]
