"""Query registrations, grouped by area. Importing this package registers all."""

from newsloom.registered import (enrich_queries, feed_queries, maintenance_queries,  # noqa: F401
                                 page_queries,
                                 search_queries,
                                 write_queries)
