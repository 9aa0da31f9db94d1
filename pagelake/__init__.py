"""pagelake: Spark tables of web pages, links, texts, articles and crawl logs.

Every operator is a function from DataFrame to DataFrame, so it composes with
``DataFrame.transform`` and leaves planning to Catalyst.
"""
