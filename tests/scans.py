"""How often the files of a table are scanned."""


def executions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsList()


def scans_of(spark, path, action):
    """The result of `action`, and the scans of `path` in the queries it ran. A scan that several
    branches of a plan share as one exchange still counts for each."""
    before = executions(spark).size()
    made = action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = executions(spark)
    name = str(path).rstrip("/").rsplit("/", 1)[1]
    count = 0
    for i in range(before, runs.size()):
        text = runs.apply(i).physicalPlanDescription()
        details = text.split("\n\n\n")
        count += sum("Scan " in d and f"/{name}" in d and "Location:" in d for d in details)
    return made, count
