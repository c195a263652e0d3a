from tidemark import build_session


def local_session():
    spark = build_session("tests", "local[8]", 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
