"""Result tables, complete jobs and registered queries."""
