"""Views derived from the given tables, in SQL that Spark and the checker both read.

``{name}`` stands for a table or another view.
"""

VIEWS = {
    # One person per customer, with the pieces that the other views put together.
    "fx_people": """
        SELECT k, name, seg, p10, email, city, st_name, st_code, zip,
          '(' || substr(p10, 1, 3) || ') ' || substr(p10, 4, 3) || '-' || substr(p10, 7, 4) AS p_fmt
        FROM (
          SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg,
            '8' || lpad(CAST((c_custkey * 7919) % 1000000000 AS STRING), 9, '0') AS p10,
            lower(replace(c_name, '#', '.')) || '@example.com' AS email,
            CASE c_custkey % 7 WHEN 0 THEN 'Tampa' WHEN 1 THEN 'MIAMI BEACH'
              WHEN 2 THEN 'St. Peter''s-By Sea' WHEN 3 THEN 'Buffalo' WHEN 4 THEN 'O''Neil'
              WHEN 5 THEN 'WINSTON-SALEM' ELSE 'Van Nuys' END AS city,
            CASE c_custkey % 6 WHEN 0 THEN 'Florida' WHEN 1 THEN 'New York'
              WHEN 2 THEN 'North Carolina' WHEN 3 THEN 'Ohio'
              WHEN 4 THEN 'District of Columbia' ELSE 'Texas' END AS st_name,
            CASE c_custkey % 6 WHEN 0 THEN 'FL' WHEN 1 THEN 'NY' WHEN 2 THEN 'NC'
              WHEN 3 THEN 'OH' WHEN 4 THEN 'DC' ELSE 'TX' END AS st_code,
            CAST(10000 + c_custkey % 90000 AS STRING) AS zip
          FROM {customer}
        ) x
    """,
    # Text blocks of a profile page.
    "fx_blocks": """
        SELECT k, name, seg, p10, p_fmt, email, city, st_name, st_code, zip,
          CASE k % 4 WHEN 0 THEN 'Phone us' WHEN 1 THEN seg || ' Group'
            WHEN 2 THEN '555-0100' ELSE 'Share' END AS tagline,
          CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'call' WHEN 2 THEN p_fmt
            WHEN 3 THEN 'Call us ' || p_fmt ELSE 'Office ' || p_fmt END AS phones,
          CASE WHEN k % 13 = 0 THEN 'Real Estate Holdings' ELSE seg || ' Holdings' END AS holding,
          CASE k % 3 WHEN 0 THEN 'Sells every Car Wash in ' || city
            WHEN 1 THEN 'Retail and land, call'
            ELSE 'Tunnel wash and gas station sales since 1999' END AS bio
        FROM {fx_people}
    """,
    "fx_profiles": """
        SELECT k AS page_id, 'https://h.example.com/profile/customer-' || CAST(k AS STRING) AS url,
          '<html><head><title>' || name || ' profile</title><script>var t="</p>";</script></head><body>'
          || CASE WHEN k % 11 = 0 THEN '' ELSE '<h1>' || name || '</h1>' END
          || '<p class="tagline">' || tagline || '</p>'
          || CASE k % 3 WHEN 0 THEN '<h2>Company Overview</h2>'
               WHEN 1 THEN '<h2>' || seg || ' LLC</h2>' ELSE '' END
          || '<div class="phones">'
          || CASE k % 5 WHEN 0 THEN ''
               WHEN 1 THEN '<a href="tel:+1' || p10 || '?x=1">call</a>'
               WHEN 2 THEN '<a href="tel:">' || p_fmt || '</a>'
               WHEN 3 THEN '<a href="tel:18886864222">Call us</a> <a href="tel:' || p10 || '">' || p_fmt || '</a>'
               ELSE '<a href="tel:12345">Office ' || p_fmt || '</a>' END
          || '</div><div class="mails">'
          || CASE k % 4 WHEN 0 THEN ''
               WHEN 1 THEN '<a href="mailto:' || email || '?subject=hi">mail</a>'
               WHEN 2 THEN '<a href="mailto:nobody">mail</a> or ' || email
               ELSE 'mail c' || CAST(k AS STRING) || ' [at] example [dot] com now' END
          || '</div><ul><li>Company<li>' || holding || '</ul>'
          || '<div><span class="pin-icon"></span><span>' || city || ', ' || st_code || ' ' || zip || '</span></div>'
          || '<div class="bio"><h3>About</h3><p>' || bio || '</div>'
          || CASE k % 6 WHEN 0 THEN '<button>Next</button>'
               WHEN 1 THEN '<button disabled>Next page</button>'
               WHEN 2 THEN '<a href="?page=2">next &raquo;</a>'
               WHEN 3 THEN '<span aria-label="Next" aria-disabled="true"></span>'
               WHEN 4 THEN '<span aria-label="Go Next"></span>' ELSE '' END
          || '</body></html>' AS html
        FROM {fx_blocks}
    """,
    # Directory pages with one card per person.
    "fx_directory": """
        SELECT k AS page_id, seg AS region, 'https://h.example.com/state/' || lower(seg) || '/' AS url,
          '<html><body><ul><li><h4>' || name || '</h4>'
          || CASE k % 3 WHEN 0 THEN '<p>' || seg || ' Group</p>' WHEN 1 THEN '' ELSE '<p>555 Holdings</p>' END
          || '<p>' || p_fmt || '</p><b><a href="../../profile/customer-' || CAST(k AS STRING)
          || '"> More  details &raquo;</a></b></li></ul></body></html>' AS html
        FROM {fx_people}
    """,
    "fx_addresses": """
        SELECT k AS id,
          CASE k % 9 WHEN 0 THEN 'Suite 5 ' || city || ', ' || st_name || ' ' || zip
            WHEN 1 THEN city || ', ' || st_code
            WHEN 2 THEN city || ', ' || st_name
            WHEN 3 THEN '12 Main' || chr(10) || city || ',' || chr(160) || st_code || chr(160) || zip || '-0001'
            WHEN 4 THEN 'we met in the office, in ' || city
            WHEN 5 THEN 'Call 12, ' || city || ',  ' || lower(st_code) || ' today, Paris, le, le'
            WHEN 6 THEN rpad('x', 70, 'y') || ', ' || st_code || ' ' || zip || ' ' || city || ', ' || st_code || ' 1'
            WHEN 7 THEN city || ', ' || st_code || '; then ' || city || ' , , ' || st_name || ', US'
            ELSE 'no place at all' END AS text
        FROM {fx_people}
    """,
    # Contacts with repeats: one per order, plus one per supplier.
    "fx_contacts": """
        SELECT o_orderkey AS ingest_ord,
          CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END AS source, n_name AS region,
          CASE WHEN k % 29 = 0 THEN ' ' WHEN o_orderkey % 3 = 0 THEN upper(name) ELSE '  ' || name || ' ' END AS full_name,
          CASE WHEN k % 7 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN p_fmt
            WHEN o_orderkey % 5 = 0 THEN '+1 ' || p10 ELSE p10 END AS phone_number,
          CASE k % 4 WHEN 0 THEN city || ', ' || st_code WHEN 1 THEN city || ', ' || st_name
            WHEN 2 THEN city || ',' || st_code ELSE ' ' END AS location,
          CASE WHEN k % 29 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN upper(seg) || chr(9) ELSE seg END AS company,
          CASE WHEN k % 4 = 0 THEN NULL ELSE email END AS email,
          'https://h.example.com/profile/customer-' || CAST(k AS STRING) AS source_url,
          CASE WHEN k % 3 = 0 THEN 'car wash' ELSE 'car wash; carwash' END AS notes
        FROM {orders} o JOIN {fx_people} p ON o.o_custkey = p.k
          JOIN {customer} c ON c.c_custkey = p.k JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        UNION ALL
        SELECT 10000000000 + s_suppkey AS ingest_ord, 'C' AS source, n_name AS region, s_name AS full_name,
          NULL AS phone_number, 'Tampa, FL' AS location, 'Supply ' || n_name AS company, NULL AS email,
          'https://s.example.com/' || CAST(s_suppkey AS STRING) AS source_url, NULL AS notes
        FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey
    """,
    # Listing cards: one page per order.
    "fx_cards": """
        SELECT l_orderkey AS page_id,
          CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS pos,
          CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'The ' || p_name || ' site' END AS title,
          CASE l_returnflag
            WHEN 'R' THEN 'Former bakery with ' || p_name
            WHEN 'A' THEN CASE WHEN l_partkey % 3 = 0 THEN 'Two lots in Orlando'
              ELSE 'call 8' || lpad(CAST(l_partkey AS STRING), 9, '0') || ' or s' || CAST(l_suppkey AS STRING) || '@example.com' END
            ELSE CASE WHEN l_partkey % 3 = 0 THEN 'Express Car Wash near ' || p_brand
              WHEN l_partkey % 3 = 1 THEN 'A QSR pad' ELSE '' END END AS description,
          CASE WHEN l_partkey % 5 = 0 THEN '' ELSE p_type END AS type,
          CASE WHEN l_linestatus = 'F' THEN 'Closed 2023' ELSE 'For lease' END AS parent_text
        FROM {lineitem} l JOIN {part} p ON p.p_partkey = l.l_partkey
    """,
    # Listing pages: two cards, or a labelled section where there are none.
    "fx_listing_pages": """
        SELECT p_partkey AS page_id, 'https://h.example.com/profile/part-' || CAST(p_partkey AS STRING) AS url,
          '<html><body><h1>' || p_name || '</h1><p>Intro text</p>'
          || CASE WHEN p_partkey % 5 = 0 THEN '<h4>Sold Listings</h4><div><div>A ' || p_name
               || ' carwash on a corner pad with plenty of room, sold last year</div></div><h4>Active Properties</h4><div>short</div>'
             ELSE '<section><h4>Our picks</h4><div class="listing-card"><h3>The ' || p_name || ' site</h3>'
               || '<p class="description">' || CASE p_partkey % 3 WHEN 0 THEN 'Corner gas station' WHEN 1 THEN 'Nice lot' ELSE 'Express Car' END
               || '</p><span class="category">' || p_type || '</span></div></section>'
               || '<div>Closed deals<article><h5>Car Wash ' || p_brand || '</h5></article></div>' END
          || '</body></html>' AS html
        FROM {part}
    """,
    # Keywords out of the data: part names and their words, part types, benchmark texts; shorter ones first.
    "dim_words": """
        SELECT CAST(length(w) AS INT) AS ord, w AS kw FROM (
          SELECT p_name AS w FROM {part}
          UNION SELECT split_part(p_name, ' ', 1) FROM {part}
          UNION SELECT split_part(p_name, ' ', 2) FROM {part}
          UNION SELECT p_type FROM {part}
          UNION SELECT text FROM {benchmark}
        ) x WHERE w <> ''
    """,
}
