"""Spark-native preparation and analysis of collective-blog data.

Pages and post documents become tables of posts, flat comment trees,
profiles and links; keyed collections are kept by batch or streaming
upsert; derived tables (post summary, participant ranking, crawl
frontiers, bag-of-words corpus) are declared with the DataFrame API so
that Catalyst plans them.
"""

__all__ = ["session"]
