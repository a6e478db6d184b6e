"""Turn landed news-crawl data into clean, reconcilable tables with Spark."""
