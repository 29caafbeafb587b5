"""End-to-end plans composed from the operators: census job, SPJA queries, federation."""
