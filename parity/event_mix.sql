CREATE OR REPLACE TEMPORARY VIEW event_days AS
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n
FROM trip_events
GROUP BY event_type, CAST(ts AS DATE);

SELECT event_type, count(*) AS days, sum(n) AS events, max(n) AS busiest
FROM event_days
GROUP BY event_type;
