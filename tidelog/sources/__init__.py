"""Where records come from and go to: log tables on files, and the live connector."""
