"""Reading feeds, pages and reports; writing results."""
