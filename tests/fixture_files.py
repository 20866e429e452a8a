"""A small shop in raw files, with one row per kind of defect. All rows are made up for these tests."""

from pathlib import Path

CUSTOMERS = """customer_id,first_name,last_name,email,phone,signup_date,country,state,postal_code,is_active,loyalty_points
1, Ada , Byron , Ada@Shop.ORG ,+44 20 7946 0000,2022-03-01,U.S.A.,ny,00501,TRUE,10
2,Bo,Li,bo@shop.org,(212)555-0101,2022-3-2,canada,ON,K1A0B1,false,-4
3,Cy,Ott,cy@shop.org,2125550102,2022-03-03,Peru,Lima,15001,true,999999
4,Di,Roe,di@shop.org,2125550103,2022-03-04,US,MN,55401,Yes,5
5,Ed,Poe,ed.shop.org,2125550104,2022-03-05,US,MN,55401,true,5
6,Flo,Moe,flo@shop.org,555,2022-03-06,US,MN,55401,true,5
7,Gus,Noe,gus@shop.org,2125550106,2022/03/07,US,MN,55401,true,5
8,Hal,Coe,hal@shop.org,2125550107,2022-02-30,US,MN,55401,true,5
9,Ida,Foe,ida@shop.org,2125550108,2022-03-09,US,MN,,true,5
10,Jo,Hoe,jo@shop.org,2125550109,2022-03-10,US,MN,55401,true,
XYZ,Kay,Doe,kay@shop.org,2125550110,2022-03-11,US,MN,55401,true,5
,Lou,Doe,lou@shop.org,2125550111,2022-03-12,US,MN,55401,true,5
3,Cy,Ott,cy@shop.org,2125550102,2022-03-03,Peru,Lima,15001,true,999999
"""

PRODUCTS = '''product_id,product_name,category,brand,price,cost,stock_quantity,weight_kg,created_date,is_active
P0001,Lamp,Home,Lux,$19.99,9.00,5,1.5,2022-01-01,TRUE
P0002,"Screen 27""",Tech,,"399,99",250,0,?,2022/01/02,Yes
 P0003 ,Pen,Office,Ink,1.50,2,100,.01,2022-01-03,n
P0004,Cup,Kitchen,Mug,N/A,1,1,1,2022-01-04,TRUE
P0005,Pan,Kitchen,Mug,-5,1,1,1,2022-01-05,TRUE
P0006,Pot,Kitchen,Mug,5,?,1,1,2022-01-06,TRUE
P0007,Rug,Home,Lux,5,1,-1,1,2022-01-07,TRUE
P0008,Mat,Home,Lux,5,1,,1,2022-01-08,TRUE
P0009,Bin,Home,Lux,5,1,1,1,2022-02-30,TRUE
P0010,Box,Home,Lux,5,1,1,1,2022-01-10,1
BADID,Bag,Home,Lux,5,1,1,1,2022-01-11,TRUE
P0001,Lamp,Home,Lux,$19.99,9.00,5,1.5,2022-01-01,TRUE
'''

ORDERS = """order_id,customer_id,product_id,order_date,ship_date,quantity,unit_price,discount_pct,total_amount,payment_method,order_status
101,1,P0001,2023-01-05,2023-01-07,3,$19.99,10,53.97,Card,Delivered
102,2,P0002,2023/01/06,01-09-2023,1,399.99,0%,399.99,Cash,Shipped
103,3,P0003,01/07/2023,2023-01-09,10,1.50,100,15.00,Card,Cancelled
 104 ,1,P0002,2023-02-01,2023-02-02,2,390.05,2.5,1.00, Card ,Pending
105,1,P0001,2023-02-03,,1,19.99,0,19.99,Card,Delivered
106,1,P0001,2023-02-30,2023-03-01,1,19.99,0,19.99,Card,Delivered
107,1,P0001,2023-02-03,2023-02-04,0,19.99,0,0,Card,Delivered
108,1,P0001,2023-02-03,2023-02-04,many,19.99,0,0,Card,Delivered
109,1,P0001,2023-02-03,2023-02-04,1,-19.99,0,0,Card,Delivered
110,1,P0001,2023-02-03,2023-02-04,1,19.99,150,19.99,Card,Delivered
111,1,P0001,2023-02-03,2023-02-04,1,19.99,abc,19.99,Card,Delivered
112,1,P0001,2023-02-03,2023-02-04,1,19.99,0,-19.99,Card,Delivered
113,XYZ,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
114,1,BADID,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
115,1,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99, null ,Delivered
116,99,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
117,1,P0099,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
118,4,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
9999999999999999999999999,1,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
NULL,1,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
A-1,1,P0001,2023-02-03,2023-02-04,1,19.99,0,19.99,Card,Delivered
101,1,P0001,2023-01-05,2023-01-07,3,$19.99,10,53.97,Card,Delivered
"""


def write_shop(folder: Path) -> Path:
    for name, text in (("customers", CUSTOMERS), ("products", PRODUCTS), ("orders", ORDERS)):
        (folder / f"{name}.csv").write_text(text)
    return folder
