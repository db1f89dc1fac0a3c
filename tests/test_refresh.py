"""Small extracts through the whole refresh, with every kind of dirt the cleansing knows."""

from datetime import date

import pytest

from tierloom.plans import checks, reports
from tierloom.plans.refresh import build_star, cleanse_all, land, read_cleansed, register_views
from tierloom.sources.landing import LANDING_FILES
from tierloom.sources.tables import AUDIT_COLUMN

AS_OF = "2024-06-30"

EXTRACTS = {
    "crm_cust_info": [
        "id,key,first,last,status,gender,created",
        "11000,AW00011000, Jon,Yang ,M,M,2025-10-06",
        "11000,AW00011000,Jon,Young,S,M,2025-10-05",
        "11001,AW00011001,Eugene,Huang,S,,2025-10-06",
        "11002,AW00011002,Ruben,,x,f,2025-10-06",
        ",PO25,,,,,",
    ],
    "crm_prd_info": [
        "id,key,name,cost,line,start,end",
        "510,CO-RF-FR-X10-1,HL Road Frame,,R ,2004-05-01,",
        "512,AC-HE-HL-Q7-B,Helmet,12,S ,2010-03-01,2006-11-03",
        "513,AC-HE-HL-Q7-B,Helmet,14,S ,2012-03-01,2007-11-03",
        "514,AC-HE-HL-Q7-B,Helmet,13,S ,2013-03-01,",
        "515,CO-PE-PD-Z3,Pedal,20,,2013-03-01,",
    ],
    "crm_sales_details": [
        "order,product,customer,ordered,shipped,due,sales,quantity,price",
        "SO1,HL-Q7-B,11000,20130101,20130108,20130113,26,2,13",
        "SO1,FR-X10-1,11000,0,20130108,20130113,,1,100",
        "SO2,HL-Q7-B,11001,20130102,20130109,20130114,30,2,-13",
        "SO3,NO-SUCH,99999,5489,20130109,20130231,10,3,",
    ],
    "crm_camp_info": [
        "id,name,channel,budget,start,end",
        "C1, New Year ,SOCIAL_MEDIA,100.5,2022-01-01,2022-01-31",
        "C2,Spring,e-mail,-50.5,03/01/2022,02/01/2022",
        "C3,Summer,fax,,2022-06-01,soon",
        "C4,Autumn,E_Mail,20,2022-09-01,2022-09-03",
    ],
    "crm_supp_tkts": [
        "id,customer,product,employee,issue,status,opened,resolved",
        "T1,11000,HL_Q7_B,EMP001,billing,open,06/01/2024,",
        "T2,999999,PRD-HL-Q7-B,EMP301,TECHNICAL,Clsd,2024-01-01,2024-01-11",
        "T3,,,,misc,pend,2024-05-01,",
        "T4,11001, HL-Q7-B ,EMP001,Returns,Resolved,2024-01-01,01/06/2024",
    ],
    "erp_cust_az12": [
        "id,born,gender",
        "NASAW00011000,1971-10-06,Male",
        "AW00011001,2050-01-01,F",
        "AW00011002,1980-01-01,M",
    ],
    "erp_loc_a101": ["id,country", "AW-00011000,US", "AW-00011001, DE", "AW-00011002,"],
    "erp_px_cat_g1v2": [
        "id,cat,subcat,maintenance",
        "AC_HE,Accessories,Helmets,Yes",
        "CO_RF,Components,Road Frames,Yes",
        "CO_PD,Components,Pedals,No",
    ],
    "erp_hr_hx19": [
        "id,first,last,role,branch,hired",
        "EMP001, Donald,Brown,Analst,BR002,2018-07-11",
        "EMP001,Donald,Brown,T.Lead,,04/04/2024",
        "EMP002,,Green,Pilot ,BR001,02/30/2010",
    ],
    "erp_vnd_z90": [
        "id,name,country",
        "V1,Zeta Supplies,us",
        "V1,Acme,england",
        "V2,,Peru ",
    ],
    "erp_inv_q4v1": [
        "id,product,warehouse,stock,reorder,day",
        "I1,514, warehouse a ,-3,5,2024-01-01",
        "I1,514,Warehouse A,8,5,12/31/2023",
        "I2,512,wh b,9,5,2024-01-01",
        "I3,99999,wh b,9,5,2024-01-01",
        "I4,510,wh b,2,x,2024-01-01",
    ],
    "erp_po_ord44": [
        "number,vendor,product,quantity,cost,day",
        "P1,V1,514,2.5,$10.50,01/15/2024",
        "P1,V1,514,9,$9,2024-01-14",
        "P2,,514,1,N/A,2024-01-15",
        "P3,V9,512,4,7,2024-02-01",
    ],
}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    for name, lines in EXTRACTS.items():
        path = root / "extracts" / LANDING_FILES[name]
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes("\r\n".join(lines).encode())
    loads = land(spark, str(root / "extracts"), str(root / "landed"))
    assert {x.table: x.rows for x in loads} == {n: len(v) - 1 for n, v in EXTRACTS.items()}
    for _ in range(2):  # a refresh can be repeated
        cleanse_all(spark, str(root / "landed"), str(root / "cleansed"), AS_OF)
    cleansed = {name: read_cleansed(spark, str(root / "cleansed"), name) for name in EXTRACTS}
    return cleansed, build_star(cleansed, AS_OF)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def day(text):
    return date.fromisoformat(text)


def test_cleansed_customers(layers):
    table = layers[0]["crm_cust_info"].drop(AUDIT_COLUMN)
    assert rows(table) == [
        (11000, "AW00011000", "Jon", "Yang", "Married", "Male", day("2025-10-06")),
        (11001, "AW00011001", "Eugene", "Huang", "Single", "n/a", day("2025-10-06")),
        (11002, "AW00011002", "Ruben", None, "n/a", "Female", day("2025-10-06")),
    ]


def test_cleansed_products(layers):
    assert rows(layers[0]["crm_prd_info"].drop(AUDIT_COLUMN, "prd_nm")) == [
        (510, "CO_RF", "FR-X10-1", 0, "Road", day("2004-05-01"), None),
        (512, "AC_HE", "HL-Q7-B", 12, "Other Sales", day("2010-03-01"), day("2012-02-29")),
        (513, "AC_HE", "HL-Q7-B", 14, "Other Sales", day("2012-03-01"), day("2013-02-28")),
        (514, "AC_HE", "HL-Q7-B", 13, "Other Sales", day("2013-03-01"), None),
        (515, "CO_PE", "PD-Z3", 20, "n/a", day("2013-03-01"), None),
    ]


def test_cleansed_sales(layers):
    assert rows(
        layers[0]["crm_sales_details"], "sls_ord_num", "sls_order_dt", "sls_due_dt", "sls_sales", "sls_price"
    ) == [
        ("SO1", None, day("2013-01-13"), 100, 100),
        ("SO1", day("2013-01-01"), day("2013-01-13"), 26, 13),
        ("SO2", day("2013-01-02"), day("2013-01-14"), 26, 15),
        ("SO3", None, None, 10, 3),
    ]


def test_cleansed_campaigns_and_tickets(layers):
    assert rows(layers[0]["crm_camp_info"].drop(AUDIT_COLUMN)) == [
        ("C1", "New Year", "Social Media", 100.5, day("2022-01-01"), day("2022-01-31"), 0),
        ("C2", "Spring", "Email", 50.5, day("2022-03-01"), day("2022-02-01"), 1),
        ("C3", "Summer", "Other", 0.0, day("2022-06-01"), None, 0),
        ("C4", "Autumn", "Email", 20.0, day("2022-09-01"), day("2022-09-03"), 0),
    ]
    assert rows(layers[0]["crm_supp_tkts"].drop(AUDIT_COLUMN, "tkt_open_date")) == [
        ("T1", 11000, "HL-Q7-B", "EMP001", "Billing", "Open", None),
        ("T2", None, "HL-Q7-B", None, "Technical", "Closed", day("2024-01-11")),
        ("T3", None, None, None, "Unknown", "Pending", None),
        ("T4", 11001, "HL-Q7-B", "EMP001", "Returns", "Resolved", day("2024-01-06")),
    ]


def test_cleansed_reference_tables(layers):
    cleansed = layers[0]
    assert rows(cleansed["erp_cust_az12"].drop(AUDIT_COLUMN)) == [
        ("AW00011000", day("1971-10-06"), "Male"),
        ("AW00011001", None, "Female"),
        ("AW00011002", day("1980-01-01"), "Male"),
    ]
    assert rows(cleansed["erp_loc_a101"], "cid", "cntry") == [
        ("AW00011000", "United States"), ("AW00011001", "Germany"), ("AW00011002", "n/a"),
    ]
    assert cleansed["erp_px_cat_g1v2"].count() == 3
    assert rows(cleansed["erp_hr_hx19"].drop(AUDIT_COLUMN)) == [
        ("EMP001", "Donald", "Brown", "Donald Brown", "Team Lead", "Unknown", day("2024-04-04")),
        ("EMP002", "N/A", "Green", "N/A Green", "Pilot", "BR001", None),
    ]
    # the first record of the file, though the other one sorts before it
    assert rows(cleansed["erp_vnd_z90"].drop(AUDIT_COLUMN)) == [
        ("V1", "Zeta Supplies", "United States"), ("V2", "Unknown Vendor", "Peru"),
    ]


def test_cleansed_stock_and_purchases(layers):
    assert rows(layers[0]["erp_inv_q4v1"].drop(AUDIT_COLUMN)) == [
        ("I1", 514, "WAREHOUSE A", 0, 5, 1, day("2024-01-01")),
        ("I2", 512, "WH B", 9, 5, 0, day("2024-01-01")),
        ("I4", 510, "WH B", 2, None, 0, day("2024-01-01")),
    ]
    assert rows(layers[0]["erp_po_ord44"].drop(AUDIT_COLUMN)) == [
        ("P1", "V1", 514, 3, 10.5, 31.5, day("2024-01-15"), 0),
        ("P2", None, 514, 1, None, None, day("2024-01-15"), 1),
        ("P3", "V9", 512, 4, 7.0, 28.0, day("2024-02-01"), 1),
    ]


def test_dimensions(layers):
    star = layers[1]
    assert rows(star["dim_customers"], "customer_key", "customer_id", "country", "gender", "birth_date") == [
        (1, 11000, "United States", "Male", day("1971-10-06")),
        (2, 11001, "Germany", "Female", None),
        (3, 11002, "n/a", "Female", day("1980-01-01")),
    ]
    assert rows(star["dim_products"], "product_key", "product_id", "category", "cost") == [
        (1, 510, "Components", 0), (2, 514, "Accessories", 13), (3, 515, None, 20),
    ]
    assert rows(star["dim_employees"], "employee_id", "years_of_service", "seniority_band") == [
        ("EMP001", 0, "Junior"), ("EMP002", None, "Veteran"),
    ]
    assert rows(star["dim_vendors"], "vendor_id", "vendor_region") == [
        ("V1", "North America"), ("V2", "Other"),
    ]
    assert rows(star["dim_campaigns"], "campaign_id", "campaign_duration_days", "campaign_year") == [
        ("C1", 30, 2022), ("C2", -28, 2022), ("C3", None, 2022), ("C4", 2, 2022),
    ]


def test_facts(layers):
    star = layers[1]
    assert rows(star["fact_sales"], "order_number", "product_key", "customer_key", "sales_amount") == [
        ("SO1", 1, 1, 100), ("SO1", 2, 1, 26), ("SO2", 2, 2, 26), ("SO3", None, None, 10),
    ]
    assert rows(
        star["fact_support_tickets"],
        "id", "days_to_resolve", "is_overdue", "customer_full_name", "agent_role", "product_key",
    ) == [
        ("T1", 29, 0, "Jon Yang", "Team Lead", "HL-Q7-B"),
        ("T2", 10, 0, " ", None, "HL-Q7-B"),
        ("T3", 60, 1, " ", None, None),
        ("T4", 5, 1, "Eugene Huang", "Team Lead", "HL-Q7-B"),
    ]
    assert rows(
        star["fact_inventory"], "inventory_id", "product_id", "stock_vs_reorder", "estimated_stock_value"
    ) == [("I1", 514, -5, 0), ("I2", None, 4, 0), ("I4", 510, None, 0)]
    assert rows(
        star["fact_purchase_orders"], "po_number", "order_year", "order_month", "vendor_id", "product_id", "total_cost"
    ) == [("P1", 2024, 1, "V1", 514, 31.5), ("P2", 2024, 1, None, 514, None), ("P3", 2024, 2, None, None, 28.0)]


def test_suites(layers):
    cleansed, star = layers
    found = {r.check_name: r.issue_count for r in checks.check_cleansed(cleansed, AS_OF).collect()}
    assert len(found) == 71
    assert {k: v for k, v in found.items() if v} == {
        "silver.crm_cust_info - NULL cst_lastname": 1,
        "silver.crm_sales_details - duplicate sls_ord_num": 1,
    }
    found = {r.check_name: r.issue_count for r in checks.check_star(star, AS_OF).collect()}
    assert len(found) == 53
    assert {k: v for k, v in found.items() if v} == {
        "dim_customers - NULL last_name": 1,
        "dim_products - NULL category": 1,
        "fact_sales - NULL product_key (unresolved product join)": 1,
        "fact_sales - NULL customer_key (unresolved customer join)": 1,
        "fact_support_tickets - NULL product_key (unresolved product join)": 1,
        "fact_inventory - NULL product_id (unresolved product join)": 1,
        "fact_purchase_orders - NULL product_id (unresolved product join)": 1,
    }


def test_reports(layers):
    star = layers[1]
    assert [tuple(r) for r in reports.top_customers(star["fact_sales"], star["dim_customers"]).collect()] == [
        (11000, "Jon Yang", 126), (11001, "Eugene Huang", 26),
    ]
    assert len(reports.top_customers(star["fact_sales"], star["dim_customers"], 1).collect()) == 1
    assert [
        tuple(r) for r in reports.agent_performance(star["fact_support_tickets"], star["dim_employees"]).collect()
    ] == [("Donald Brown", "Team Lead", 2, 17.0, 17, 1)]
    assert [tuple(r) for r in reports.inventory_alerts(star["fact_inventory"]).collect()] == [
        ("WAREHOUSE A", "Helmet", "Accessories", 0, 5, -5)
    ]
    assert [
        tuple(r) for r in reports.vendor_spend(star["fact_purchase_orders"], star["dim_vendors"]).collect()
    ] == [("Zeta Supplies", "United States", "North America", 1, 31.5, 10.5)]
    assert [tuple(r) for r in reports.channel_budget(star["dim_campaigns"]).collect()] == [
        ("Social Media", 1, 100.5, 30.0, 30), ("Email", 1, 20.0, 2.0, 2), ("Other", 1, 0.0, None, None),
    ]
    assert rows(reports.order_rollup(star["fact_sales"])) == [
        ("SO1", 2, 3, 126, day("2013-01-01"), day("2013-01-08")),
        ("SO2", 1, 2, 26, day("2013-01-02"), day("2013-01-09")),
        ("SO3", 1, 3, 10, None, day("2013-01-09")),
    ]


def test_views(spark, layers):
    register_views(layers[1], "star_")
    counted = spark.sql("SELECT count(*) AS n FROM star_fact_sales JOIN star_dim_customers USING (customer_key)")
    assert counted.first().n == 3
