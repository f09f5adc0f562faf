"""Writers: tables, views, reports, messages and models."""
